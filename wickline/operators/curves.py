"""Threshold curves and the tables derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.operators.metrics import cumulative_counts
from wickline.operators.running import ROWS_PER_BUCKET, cut_points, next_values, with_bucket


def _cumulative(df: DataFrame, y: str, p: str, rows_per_bucket: int):
    """Counts at and above each distinct score, and the two totals as columns."""
    cuts = cut_points(df, p, rows_per_bucket)
    down = cumulative_counts(df, (), y, p, cuts)
    totals = df.agg(F.count_if(F.col(y) == 1).alias("P"), F.count_if(F.col(y) != 1).alias("N")).first()
    return down, cuts, totals["P"], totals["N"]


def pr_curve(df: DataFrame, y: str = "y", p: str = "p", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Precision and recall when predicting 1 at each score or above; the end point has no threshold."""
    down, _, positives, _ = _cumulative(df, y, p, rows_per_bucket)
    recall = F.lit(1.0) if positives == 0 else F.col("tp") / F.lit(float(positives))
    points = down.select(F.col("score").alias("threshold"),
                         (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), recall.alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], points.schema)
    return points.unionByName(end)


def roc_points(df: DataFrame, y: str = "y", p: str = "p", rows_per_bucket: int = ROWS_PER_BUCKET,
               drop_collinear: bool = False) -> DataFrame:
    """False and true positive rate at each score, with the counts."""
    down, cuts, positives, negatives = _cumulative(df, y, p, rows_per_bucket)
    if drop_collinear:
        ahead = next_values(down, "score", {"next_pos": "pos", "next_neg": "neg"}, (), cuts, descending=True)
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        bend = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        down = ahead.where(first | bend | F.col("next_pos").isNull())
    rate = lambda c, n: (F.col(c) / F.lit(float(n)) if n else F.lit(None).cast("double"))
    return down.select(F.col("score").alias("threshold"), rate("fp", negatives).alias("fpr"),
                       rate("tp", positives).alias("tpr"), "tp", "fp",
                       (F.lit(positives) - F.col("tp")).alias("fn"), (F.lit(negatives) - F.col("fp")).alias("tn"))


def roc_curve(df: DataFrame, y: str = "y", p: str = "p", rows_per_bucket: int = ROWS_PER_BUCKET,
              drop_collinear: bool = False) -> DataFrame:
    """The ROC curve from the origin (threshold infinity) to (1, 1)."""
    points = roc_points(df, y, p, rows_per_bucket, drop_collinear).select("threshold", "fpr", "tpr")
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return origin.unionByName(points)


def threshold_table(df: DataFrame, thresholds: Sequence[float], y: str = "y", p: str = "p") -> DataFrame:
    """tp, fp, fn, tn when predicting 1 at or above each threshold: one pass, one count per stretch."""
    cuts = sorted({float(t) for t in thresholds})
    placed = with_bucket(df.select(F.col(y).alias("y"), F.col(p).alias("p")), "p", cuts, "slot")
    counts = placed.groupBy("slot").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    slots = df.sparkSession.createDataFrame([(0, None)] + [(i + 1, t) for i, t in enumerate(cuts)],
                                            "slot int, threshold double")
    full = slots.join(counts, "slot", "left").na.fill(0, ["pos", "neg"])
    above = Window.orderBy(F.col("slot").desc()).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy(F.col("slot")).rowsBetween(Window.unboundedPreceding, -1)
    return full.select("threshold", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
                       F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"),
                       F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn")).where(F.col("threshold").isNotNull())


# Gain of a hit (and loss of a miss) of the two payoff structures; cost of a false alarm
# and of each action.
PAYOFFS = {"old_structure": 10, "new_structure": 100}
FALSE_ALARM_COST, ACTION_COST = 2, 1


def benefit_structure(df: DataFrame, thresholds: Sequence[float], payoffs: dict[str, int] | None = None,
                      y: str = "y", p: str = "p") -> DataFrame:
    """Net benefit of acting at each threshold under each payoff structure."""
    table = threshold_table(df, thresholds, y, p)
    offers = F.array(*[F.struct(F.lit(n).alias("structure"), F.lit(g).cast("bigint").alias("gain"))
                       for n, g in (payoffs or PAYOFFS).items()])
    rows = table.select("threshold", "tp", "fp", "fn", "tn", F.inline(offers))
    benefit = (F.col("gain") * (F.col("tp") - F.col("fn")) - FALSE_ALARM_COST * F.col("fp")
               - ACTION_COST * (F.col("tp") + F.col("fp")))
    return rows.select("threshold", "structure", "tp", "fp", "fn", "tn", benefit.alias("benefit"))


def best_threshold(df: DataFrame, y: str = "y", p: str = "p", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Thresholds with the greatest Youden index and the greatest F1; the higher threshold on ties."""
    points = roc_points(df, y, p, rows_per_bucket)
    f1 = F.col("tp") * 2.0 / (F.col("tp") * 2.0 + F.col("fp") + F.col("fn"))
    best = points.agg(F.max(F.struct((F.col("tpr") - F.col("fpr")).alias("v"), "threshold")).alias("youden"),
                      F.max(F.struct(f1.alias("v"), "threshold")).alias("f1"))
    return best.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("criterion"), F.col(f"{n}.threshold").alias("threshold"), F.col(f"{n}.v").alias("value"))
        for n in ("youden", "f1")])))
