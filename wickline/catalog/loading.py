"""Watermarks, slices and loads."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.operators import incremental
from wickline.operators.casting import cast_klines, stamp_lineage
from wickline.plans.dataops import Market, run_dataops
from wickline.session import fresh_path
from wickline.sources.kline_pages import write_kline_pages


def _first(df):
    return df.where(F.col("open_time") < d.SECOND_LOAD_MS)


def q_high_watermark(spark, sf):
    return incremental.high_watermark(d.klines_raw(spark, sf))


def q_next_start(spark, sf):
    return incremental.next_start(d.klines_raw(spark, sf), d.HOUR_MS)


def q_incremental_slice(spark, sf):
    df = d.klines_raw(spark, sf)
    return incremental.incremental_slice(df, _first(df), d.HOUR_MS).select("symbol", *schemas.PAGE_COLUMNS)


def q_pending_transform(spark, sf):
    """Candles of few trades were never transformed."""
    raw = d.klines_stamped(spark, sf)
    done = raw.where("number_of_trades > 2")
    return incremental.pending_transform(raw, done).select(*schemas.KEY, "number_of_trades")


def q_upsert_latest(spark, sf):
    """A later run restates the second half of the candles with doubled trade counts."""
    old = stamp_lineage(d.klines_raw(spark, sf), d.RUN_TS)
    late = d.klines_raw(spark, sf).where(F.col("open_time") >= d.SECOND_LOAD_MS).withColumn(
        "number_of_trades", F.col("number_of_trades") * 2)
    new = stamp_lineage(late, d.RUN_TS + timedelta(days=1))
    return incremental.upsert_latest(old, new)


def _market(spark):
    name = f"market_{uuid.uuid4().hex[:12]}"
    return Market(name, fresh_path(spark, name), d.HOUR_MS)


def _report(spark, market):
    raw = spark.table(market.raw).groupBy("symbol", "updated_at").agg(F.count("*").alias("rows"))
    done = spark.table(market.transformed).groupBy("symbol", "updated_at").agg(F.count("*").alias("transformed"))
    return raw.join(done, ["symbol", "updated_at"], "left")


def q_initial_load(spark, sf):
    market, pages = _market(spark), fresh_path(spark, "pages")
    write_kline_pages(d.klines_raw(spark, sf), pages, "1h")
    run_dataops(spark, pages, market, d.RUN_TS)
    return _report(spark, market)


def q_incremental_load(spark, sf):
    """Three runs: the first half, then everything, then the same again."""
    market, early, every = _market(spark), fresh_path(spark, "pages"), fresh_path(spark, "pages")
    candles = d.klines_raw(spark, sf)
    write_kline_pages(_first(candles), early, "1h")
    write_kline_pages(candles, every, "1h")
    run_dataops(spark, early, market, d.RUN_TS)
    run_dataops(spark, every, market, d.RUN_TS + timedelta(days=1))
    run_dataops(spark, every, market, d.RUN_TS + timedelta(days=2))
    return _report(spark, market)


def q_write_upsert(spark, sf):
    """The upsert written into a table partitioned by day: only the restated days are rewritten."""
    from wickline.plans.dataops import with_day

    path, staging = fresh_path(spark, "upsert"), fresh_path(spark, "upsert-staging")
    with_day(stamp_lineage(d.klines_raw(spark, sf), d.RUN_TS)).write.partitionBy("day").parquet(path)
    late = d.klines_raw(spark, sf).where(F.col("open_time") >= d.SECOND_LOAD_MS).withColumn(
        "number_of_trades", F.col("number_of_trades") * 2)
    changes = with_day(stamp_lineage(late, d.RUN_TS + timedelta(days=1)))
    incremental.write_upsert(path, changes, "day", schemas.KEY, "updated_at", staging)
    return spark.read.parquet(path).groupBy("symbol", "updated_at").agg(
        F.count("*").alias("rows"), F.sum("number_of_trades").alias("trades"))


QUERIES = {
    "high_watermark": q_high_watermark, "next_start": q_next_start, "incremental_slice": q_incremental_slice,
    "pending_transform": q_pending_transform, "upsert_latest": q_upsert_latest, "initial_load": q_initial_load,
    "incremental_load": q_incremental_load, "write_upsert": q_write_upsert,
}

_K = f"with {d.KLINES_SQL}"
_CELLS = ", ".join(c for c in schemas.PAGE_COLUMNS)
ORACLES = {
    "high_watermark": f"{_K} select symbol, max(open_time) as watermark from klines group by 1",
    "next_start": f"{_K} select symbol, max(open_time) + 3600000 as next_start from klines group by 1",
    "incremental_slice": f"""{_K}, w as (select symbol, max(open_time) + 3600000 as s from klines
  where open_time < {d.SECOND_LOAD_MS} group by 1)
select k.symbol, {', '.join('k.' + c for c in schemas.PAGE_COLUMNS)} from klines k left join w using (symbol)
where s is null or open_time >= s""",
    "pending_transform": f"{_K} select symbol, open_time, number_of_trades from klines where number_of_trades <= 2",
    "upsert_latest": f"""{_K} select * replace (
  case when open_time >= {d.SECOND_LOAD_MS} then number_of_trades * 2 else number_of_trades end as number_of_trades,
  case when open_time >= {d.SECOND_LOAD_MS} then timestamp '2024-02-02' else updated_at end as updated_at) from stamped""",
    "initial_load": f"""{_K} select symbol, timestamp '2024-02-01' as updated_at, count(*) as rows, count(*) as transformed
from klines group by 1""",
    "incremental_load": f"""{_K} select symbol, case when open_time < {d.SECOND_LOAD_MS} then timestamp '2024-02-01'
  else timestamp '2024-02-02' end as updated_at, count(*) as rows, count(*) as transformed from klines group by 1, 2""",
    "write_upsert": f"""{_K} select symbol, case when open_time < {d.SECOND_LOAD_MS} then timestamp '2024-02-01'
  else timestamp '2024-02-02' end as updated_at, count(*) as rows,
  sum(case when open_time < {d.SECOND_LOAD_MS} then number_of_trades else 2 * number_of_trades end)::bigint as trades
from klines group by 1, 2""",
}
