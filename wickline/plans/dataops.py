"""First and incremental loads of candle pages into the raw and the transformed table."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline import schemas
from wickline.operators.casting import cast_klines, stamp_lineage
from wickline.operators.incremental import incremental_slice
from wickline.operators.quality import ensure_valid, validate_frame
from wickline.operators.shaping import dedupe_latest
from wickline.small import fetch_if_small
from wickline.sources import snapshots, tables
from wickline.sources.file_index import FileIndex
from wickline.sources.kline_pages import read_kline_pages


@dataclass(frozen=True)
class Market:
    """Where a market's tables, snapshots and manifest lie."""

    dataset: str
    root: str
    interval_ms: int
    raw_table: str = "raw_klines"
    transformed_table: str = "transformed_klines"

    @property
    def raw(self) -> str:
        return f"{self.dataset}.{self.raw_table}"

    @property
    def transformed(self) -> str:
        return f"{self.dataset}.{self.transformed_table}"

    @property
    def raw_index(self) -> FileIndex:
        return _index(f"{self.root}/index/{self.raw_table}", F.col("open_time").cast("long"))

    @property
    def transformed_index(self) -> FileIndex:
        return _index(f"{self.root}/index/{self.transformed_table}", F.unix_millis(F.col("open_time").cast("timestamp")))


def _index(path: str, millis: Column) -> FileIndex:
    """Of each file, day and symbol: the newest time, the rows and the sum of their keys' hashes."""
    return FileIndex(path, {"day": F.col("day"), "symbol": F.col("symbol")}, {
        "newest": (millis, "max"), "rows": (F.lit(1).cast("long"), "sum"),
        "mark": (F.xxhash64("symbol", millis).cast("decimal(20,0)"), "sum")})


def with_day(df: DataFrame) -> DataFrame:
    """Partition column: the UTC day of the candle."""
    return df.withColumn("day", F.to_date("utc_datetime"))


def check_raw(df: DataFrame) -> None:
    """Columns, types and missing values of stamped pages, in one pass."""
    ensure_valid(validate_frame(df, {"symbol": "str", **schemas.RAW}))


def check_transformed(df: DataFrame) -> None:
    ensure_valid(validate_frame(df, {"symbol": "str", **schemas.TRANSFORMED}))


def create_tables(spark: SparkSession, market: Market) -> None:
    tables.create_dataset(spark, market.dataset, f"{market.root}/tables")

    for name, declared in ((market.raw, schemas.RAW), (market.transformed, schemas.TRANSFORMED)):
        layout = T.StructType([T.StructField("symbol", T.StringType()), *schemas.struct_of(declared).fields,
                               T.StructField("day", T.DateType())])
        tables.create_table(spark, name, layout, f"{market.root}/tables/{name.split('.')[-1]}", ["day"])


def load_raw(pages: DataFrame, market: Market, run_ts: datetime) -> int:
    """Snapshot the stamped rows, each candle once, validate the snapshot's twin in staging, then append; returns the rows."""
    spark = pages.sparkSession
    staging = f"{market.root}/staging/{run_ts:%Y%m%dT%H%M%S}"
    once = dedupe_latest(pages, schemas.KEY, [])  # page ends overlap in the feed
    with_day(stamp_lineage(once, run_ts)).write.mode("overwrite").parquet(staging)
    rows = spark.read.parquet(staging)
    n = rows.count()
    if n:
        snapshots.snapshot_csv(rows, f"{market.root}/snapshots", market.dataset, market.raw_table, run_ts)
        check_raw(rows)
        tables.append_table(rows, market.raw, partition_by=["day"])
    return n


def days_behind(raw: DataFrame, transformed: DataFrame) -> list | None:
    """Days whose keys differ between the tables; None when they are too many to list.

    A day is described by the number of its distinct keys and the sum of their hashes, so equal counts of
    different keys do not pass.
    """
    millis = F.unix_millis(F.col("open_time").cast("timestamp")).alias("open_time")
    described = lambda keys, name: keys.distinct().groupBy("day").agg(F.struct(
        F.count("*"), F.sum(F.xxhash64("symbol", "open_time").cast("decimal(38,0)"))).alias(name))
    a = described(raw.select("day", "symbol", F.col("open_time").cast("long").alias("open_time")), "r")
    b = described(transformed.select("day", "symbol", millis), "t")
    uneven = a.join(b, "day", "left").where(~F.col("r").eqNullSafe(F.col("t")))
    rows = fetch_if_small(uneven.select("day"))
    return None if rows is None else [r["day"] for r in rows]


def lagging_days(spark: SparkSession, market: Market) -> list | None:
    """``days_behind`` from the file indexes of a market's tables. Copies in one table make a day differ here, which
    costs a look at it and no more."""
    described = lambda index, table, name: index.read(spark.table(table)).groupBy("day").agg(
        F.struct(F.sum("rows"), F.sum("mark")).alias(name))
    a, b = described(market.raw_index, market.raw, "r"), described(market.transformed_index, market.transformed, "t")
    uneven = a.join(b, "day", "left").where(~F.col("r").eqNullSafe(F.col("t")))
    rows = fetch_if_small(uneven.select("day"))
    return None if rows is None else [r["day"] for r in rows]


def transform_pending(spark: SparkSession, market: Market) -> int:
    """Cast every raw row that has no transformed row, validate and append; only lagging days are read."""
    raw, transformed = spark.table(market.raw), spark.table(market.transformed)
    days = lagging_days(spark, market)
    if days == []:
        return 0
    if days is not None:
        raw, transformed = raw.where(F.col("day").isin(days)), transformed.where(F.col("day").isin(days))
    done = transformed.select("symbol", "day", F.unix_millis(F.col("open_time").cast("timestamp")).alias("open_time"))
    fresh = raw.join(done, [*schemas.KEY, "day"], "left_anti")
    path = f"{market.root}/staging/transform-{int(time.time() * 1e6)}"
    cast_klines(fresh).write.parquet(path)
    rows = spark.read.parquet(path)
    check_transformed(rows)
    n = rows.count()
    tables.append_table(rows, market.transformed, partition_by=["day"])
    return n


def _finish(spark: SparkSession, market: Market, stage: str, run_ts: datetime, n_raw: int, began: float) -> dict:
    done = transform_pending(spark, market)
    snapshots.record_run(spark, f"{market.root}/manifest", run_id=f"{run_ts:%Y%m%dT%H%M%S}", stage=stage,
                         source=market.raw, rows=n_raw, cols=len(schemas.RAW), format="csv", run_ts=run_ts,
                         seconds=time.time() - began)
    return {"raw": n_raw, "transformed": done}


def initial_load(spark: SparkSession, pages_path: str, market: Market, run_ts: datetime) -> dict:
    """Create the tables and load every landed page."""
    began = time.time()
    create_tables(spark, market)
    n = load_raw(read_kline_pages(spark, pages_path), market, run_ts)
    return _finish(spark, market, "initial", run_ts, n, began)


def incremental_load(spark: SparkSession, pages_path: str, market: Market, run_ts: datetime,
                     landed_after: datetime | None = None) -> dict:
    """Load what lies beyond each series' watermark; running it again on the same pages adds nothing.

    With ``landed_after``, usually the start of the run before, only files landed since are read. The watermarks come
    from the raw table's file index: of the files loaded before, none is opened but those of days that get new rows.
    """
    began = time.time()
    pages = read_kline_pages(spark, pages_path, landed_after=landed_after)
    loaded = market.raw_index.read(spark.table(market.raw)).select("symbol", F.col("newest").alias("open_time"))
    fresh = incremental_slice(pages, loaded, market.interval_ms)
    n = load_raw(fresh.select("symbol", *schemas.PAGE_COLUMNS), market, run_ts)
    return _finish(spark, market, "incremental", run_ts, n, began)


def run_dataops(spark: SparkSession, pages_path: str, market: Market, run_ts: datetime,
                landed_after: datetime | None = None) -> dict:
    """The scheduled entry point: initial on the first run, incremental afterwards."""
    if tables.is_first_run(spark, market.dataset, market.raw_table):
        return initial_load(spark, pages_path, market, run_ts)
    return incremental_load(spark, pages_path, market, run_ts, landed_after)
