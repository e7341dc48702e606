"""Connected components by alternating large-star and small-star rounds over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.spans import discard
from wickline.session import settled


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: each node hands its neighbours (the larger ones, or the smaller ones and itself) to the least of all.

    The least ones are written first, so that their join shuffles both sides and can split a hub's edges.
    """
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settled(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = settled(down.groupBy("u").agg(F.min("v").alias("m")), "least")
        out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; edges are (u, v), the component is its smallest node.

    Each round is written as a table, so a lost executor costs one round. Rounds grow with the logarithm of the
    longest path; hub nodes are pre-aggregated and their join can be split.
    """
    spark = edges.sparkSession
    now = settled(edges.where("u <> v").select("u", "v").distinct(), "edges")
    mark = None
    while True:
        after = settled(_star(_star(now, True), False), "edges")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(spark, now)
        now = after
        if seen == mark or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = seen
