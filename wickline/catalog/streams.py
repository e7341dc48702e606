"""Structured Streaming twins of the batch queries. Each stream reads the given table files as they lie."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.catalog.evaluation import _LOSS2
from wickline.operators.scoring import linear_score
from wickline.plans.dataops import Market
from wickline.session import fresh_path
from wickline.sources.kline_pages import write_kline_pages
from wickline.streaming.candles import stream_candles
from wickline.streaming.ingest import ingest_stream
from wickline.streaming.performance import match_labels, monitor_stream, windowed_performance
from wickline.streaming.sources import append_stream, close_stream, stream_files


def _events(spark, sf):
    schema = d.table(spark, sf, "events").schema
    return stream_files(spark, sf, "events.parquet", schema)


def _run(spark, df, label):
    path = fresh_path(spark, label)
    append_stream(df, path, fresh_path(spark, f"{label}-checkpoint"))
    return spark.read.schema(df.schema).parquet(path)


def _closed(spark, df, keys, label):
    return close_stream(df, keys, fresh_path(spark, label), fresh_path(spark, f"{label}-checkpoint"))


def _scored(df):
    p = F.col("value") / F.lit(600.0)
    return df.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                     F.col("event_type").isin("error", "signup").cast("int").alias("y"), p.alias("p"),
                     (p >= F.lit(0.4)).cast("int").alias("y_pred"))


def q_stream_candles(spark, sf):
    candles = stream_candles(d.ticks(_events(spark, sf)), "1 hour", d.HOUR_MS, "10 minutes")
    return _closed(spark, candles, ["symbol", "open_time"], "candles")


def q_stream_monitor(spark, sf):
    out = _closed(spark, monitor_stream(_scored(_events(spark, sf)), "2 hours"), ["window_start"], "monitor")
    return d.rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


def q_stream_performance(spark, sf):
    """Labels arrive up to ten hours after the prediction; the matched rows are measured per day."""
    predictions = _scored(_events(spark, sf)).drop("y")
    delay = F.make_dt_interval(F.lit(0), (F.col("user_id") % 10).cast("int"))
    labels = _scored(_events(spark, sf)).select("event_id", (F.col("ts") + delay).alias("label_ts"), "y")
    matched = match_labels(predictions, labels, "event_id", "10 hours", "1 hour")
    out = windowed_performance(_run(spark, matched, "matched"))
    return d.rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


def q_stream_score(spark, sf):
    schema = d.table(spark, sf, "lineitem").schema
    lines = stream_files(spark, sf, "lineitem.parquet", schema)
    scored = linear_score(lines, {"l_quantity": 0.02, "l_discount": 8.0, "l_tax": -10.0}, -0.5)
    return d.rounded(_run(spark, scored.select("l_orderkey", "l_linenumber", "l_shipdate", "p"), "scores"))


def q_stream_ingest(spark, sf):
    """Pages land in two lots; the second lot repeats the first. Both tables end with every candle once."""
    name = f"market_{uuid.uuid4().hex[:12]}"
    market, checkpoint = Market(name, fresh_path(spark, name), d.HOUR_MS), fresh_path(spark, "ingest-checkpoint")
    pages, candles = fresh_path(spark, "pages"), d.klines_raw(spark, sf)
    write_kline_pages(candles.where(F.col("open_time") < d.SECOND_LOAD_MS), pages, "1h")
    ingest_stream(spark, pages, market, checkpoint, d.RUN_TS)
    write_kline_pages(candles, pages, "1h", mode="append")
    ingest_stream(spark, pages, market, checkpoint, d.RUN_TS)
    raw = spark.table(market.raw).groupBy("symbol").agg(F.count("*").alias("raw"), F.max("open_time").alias("last"))
    done = spark.table(market.transformed).groupBy("symbol").agg(F.count("*").alias("transformed"))
    return raw.join(done, "symbol")


QUERIES = {
    "stream_candles": q_stream_candles, "stream_monitor": q_stream_monitor, "stream_performance": q_stream_performance,
    "stream_score": q_stream_score, "stream_ingest": q_stream_ingest,
}

_M = (f"count(*) as rows, round(avg((y = y_pred)::int),6) as accuracy, round({_LOSS2},6) as log_loss, "
      "round(avg(pow(p - y, 2)),6) as brier_score")
ORACLES = {
    "stream_candles": f"""with {d.KLINES_SQL} select symbol, {', '.join(schemas.PAGE_COLUMNS)} from klines""",
    "stream_monitor": f"""with {d.SCORED_SQL} select date_trunc('day', ts) as window_start, {_M} from scored group by 1""",
    "stream_performance": f"""with {d.SCORED_SQL} select date_trunc('day', ts) as window_start, {_M} from scored group by 1""",
    "stream_score": """select l_orderkey, l_linenumber, l_shipdate,
  round(1e0 / (1e0 + exp(-(((-0.5e0 + 0.02e0 * l_quantity) + 8e0 * l_discount) + -10e0 * l_tax))), 6) as p from lineitem""",
    "stream_ingest": f"""with {d.KLINES_SQL} select symbol, count(*) as raw, max(open_time) as last, count(*) as transformed
from klines group by 1""",
}
