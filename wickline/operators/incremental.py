"""Watermarks, slices, pending rows and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline import schemas
from wickline.operators.shaping import dedupe_latest
from wickline.small import SMALL_ROWS, fetch_if_small


def high_watermark(table: DataFrame, key: str = "symbol", time: str = "open_time") -> DataFrame:
    return table.groupBy(key).agg(F.max(time).alias("watermark"))


def next_start(table: DataFrame, interval_ms: int, key: str = "symbol", time: str = "open_time") -> DataFrame:
    """First time not loaded yet, per series."""
    return high_watermark(table, key, time).select(
        key, (F.col("watermark") + F.lit(interval_ms)).alias("next_start"))


def incremental_slice(source: DataFrame, loaded: DataFrame, interval_ms: int, key: str = "symbol",
                      time: str = "open_time", new_series: bool = True, max_series: int = SMALL_ROWS) -> DataFrame:
    """Source rows at or after each series' next start; unknown series are taken whole.

    With few series the starts are broadcast. If no new series can appear (``new_series=False``) the
    earliest start also becomes a plain file filter, which skips the files loaded long ago.
    """
    starts = next_start(loaded, interval_ms, key, time)
    rows = fetch_if_small(starts, max_series)
    if rows:
        starts = F.broadcast(source.sparkSession.createDataFrame(rows, starts.schema))
        if not new_series:
            source = source.where(F.col(time) >= F.lit(min(r["next_start"] for r in rows)))
    if not new_series:
        return source.join(starts, key).where(F.col(time) >= F.col("next_start")).drop("next_start")
    keep = F.col("next_start").isNull() | (F.col(time) >= F.col("next_start"))
    return source.join(starts, key, "left").where(keep).drop("next_start")


def pending_transform(raw: DataFrame, transformed: DataFrame, keys: Sequence[str] = schemas.KEY) -> DataFrame:
    """Raw rows without a transformed row, whatever made the earlier run stop."""
    return raw.join(transformed.select(*keys), list(keys), "left_anti")


def upsert_latest(table: DataFrame, changes: DataFrame, keys: Sequence[str] = schemas.KEY,
                  version: str = "updated_at") -> DataFrame:
    """Union of both, keeping the newest row of each key."""
    return dedupe_latest(table.unionByName(changes), list(keys), [version])


def touched_partitions(table: DataFrame, changes: DataFrame, column: str) -> DataFrame:
    """Rows of the table in the partitions that the changes fall into: what an upsert must rewrite."""
    days = changes.select(column).distinct()
    values = fetch_if_small(days)
    if values is not None:
        return table.where(F.col(column).isin([v[0] for v in values]))
    return table.join(days, column, "left_semi")


def write_upsert(table_path: str, changes: DataFrame, day: str, keys: Sequence[str], version: str,
                 staging: str) -> None:
    """Upsert into a Parquet folder partitioned by day, rewriting only the touched days.

    The merged rows are written to ``staging`` first: a folder cannot be overwritten while it is read.
    """
    spark = changes.sparkSession
    table = spark.read.parquet(table_path)
    merged = upsert_latest(touched_partitions(table, changes, day), changes.select(*table.columns), keys, version)
    merged.write.partitionBy(day).parquet(staging)
    spark.read.schema(table.schema).parquet(staging).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(day).parquet(table_path)
