"""Continuous ingest of landed candle pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline import schemas
from wickline.operators.casting import cast_klines, stamp_lineage
from wickline.operators.shaping import dedupe_latest
from wickline.plans.dataops import Market, check_raw, check_transformed, create_tables, with_day
from wickline.small import fetch_if_small
from wickline.sources.kline_pages import parse_kline_pages
from wickline.sources.tables import append_table
from wickline.streaming.sources import each_batch


def stream_pages(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """Landed page files as a stream of (value, symbol)."""
    return (spark.readStream.schema("value string, symbol string").option("maxFilesPerTrigger", per_trigger)
            .option("wholetext", False).text(path))


def ingest_batch(pages: DataFrame, batch: int, market: Market, run_ts: datetime) -> None:
    """One micro-batch: stamp, deduplicate, keep what is new, validate, append to both tables.

    The anti-join makes a repeated batch harmless; it reads only the days the batch touches.
    """
    spark = pages.sparkSession
    rows = parse_kline_pages(pages)
    stamped = stamp_lineage(rows.select("symbol", *schemas.PAGE_COLUMNS), run_ts)
    staging = f"{market.root}/staging/stream-{batch}"
    with_day(dedupe_latest(stamped, schemas.KEY, ["updated_at"])).write.mode("overwrite").parquet(staging)
    arrived = spark.read.parquet(staging)
    for name, shape, check in ((market.raw, None, check_raw), (market.transformed, cast_klines, check_transformed)):
        table = spark.table(name)
        days = fetch_if_small(arrived.select("day").distinct())
        known = table if days is None else table.where(F.col("day").isin([r["day"] for r in days]))
        seen = known.select("symbol", "day", "utc_datetime")
        fresh = arrived.join(seen, ["symbol", "day", "utc_datetime"], "left_anti").select(*arrived.columns)
        out = fresh if shape is None else shape(fresh)
        path = f"{staging}-{name.split('.')[-1]}"
        out.write.mode("overwrite").parquet(path)
        ready = spark.read.schema(out.schema).parquet(path)
        check(ready)
        append_table(ready, name, partition_by=["day"])


def ingest_stream(spark: SparkSession, pages_path: str, market: Market, checkpoint: str, run_ts: datetime,
                  per_trigger: int = 1000) -> None:
    """Bring both tables up to what has landed; run it again after more pages land."""
    create_tables(spark, market)
    each_batch(stream_pages(spark, pages_path, per_trigger),
               lambda df, batch: ingest_batch(df, batch, market, run_ts), checkpoint)
