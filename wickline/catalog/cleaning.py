"""Casts, projections, cleaning, joins and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.operators import casting, shaping

SYMBOLS = ["click", "error", "purchase", "signup", "view"]


def q_cast_klines(spark, sf):
    return casting.cast_klines(d.klines_stamped(spark, sf))


def q_convert_timezone(spark, sf):
    df = d.table(spark, sf, "events").select("event_id", "ts")
    for name, zone in (("singapore", "Asia/Singapore"), ("new_york", "America/New_York")):
        df = casting.convert_timezone(df, "ts", name, zone)
    return df


def q_cast_columns(spark, sf):
    return casting.cast_columns(d.klines_stamped(spark, sf), casting.CLEANING_TYPES)


def q_price_increase(spark, sf):
    df = d.klines_cleaned(spark, sf)
    return df.select("symbol", "open_time", "open", "close", "price_increase")


def q_select_features_target(spark, sf):
    return casting.select_features_target(d.klines_cleaned(spark, sf), keys=schemas.KEY)


def q_filter_since(spark, sf):
    df = d.table(spark, sf, "events").withColumnRenamed("ts", "utc_datetime")
    return casting.filter_since(df, d.SECOND_LOAD).select("event_id", "utc_datetime", "event_type", "value")


def q_drop_columns(spark, sf):
    return casting.drop_columns(d.table(spark, sf, "customer"), ["c_custkey", "c_name"])


def q_apply_threshold(spark, sf):
    return casting.apply_threshold(d.scored_events(spark, sf).drop("y_pred"), 0.35).select(
        "event_id", "y", "y_pred")


def with_gaps(df):
    """The volume of every seventh hour is missing."""
    gone = F.expr(f"open_time div {d.HOUR_MS} % 7 = 0")
    return df.withColumn("taker_buy_base_asset_volume", F.when(~gone, F.col("taker_buy_base_asset_volume")))


def q_drop_missing(spark, sf):
    df = with_gaps(d.klines_cleaned(spark, sf))
    return shaping.drop_missing(df, schemas.FEATURES).select("symbol", "open_time", "taker_buy_base_asset_volume")


def q_fill_missing(spark, sf):
    df = with_gaps(d.klines_cleaned(spark, sf))
    return shaping.fill_missing(df, {"taker_buy_base_asset_volume": -1.0}).select(
        "symbol", "open_time", "taker_buy_base_asset_volume")


def q_dedupe_latest(spark, sf):
    return shaping.dedupe_latest(d.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_clip_outliers(spark, sf):
    df = d.table(spark, sf, "events").select("event_id", "value")
    return d.rounded(shaping.clip_outliers(df, ["value"]))


def q_drop_outliers_z(spark, sf):
    df = d.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return shaping.drop_outliers_z(df, ["o_totalprice"], 1.5)


def q_enrich_join(spark, sf):
    """Events are summed per user before they meet the customers, so a busy user is one row in the join."""
    users = d.table(spark, sf, "events").groupBy("user_id").agg(
        F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))
    joined = shaping.enrich_join(users, d.table(spark, sf, "customer"), [("user_id", "c_custkey")], ["c_mktsegment"])
    return joined.groupBy("c_mktsegment").agg(
        F.count("*").alias("users"), F.sum("events").alias("events"), F.sum("value").cast("double").alias("value"))


def q_aggregate_klines(spark, sf):
    return d.rounded(shaping.aggregate_by(d.klines_cleaned(spark, sf), ["symbol"], ["close", "number_of_trades"]), 4)


def q_aggregate_lines(spark, sf):
    df = d.table(spark, sf, "lineitem")
    return d.rounded(shaping.aggregate_by(df, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount"]), 4)


def q_rollup_candles(spark, sf):
    return d.rounded(shaping.rollup_candles(d.klines_cleaned(spark, sf), "day"))


def q_pivot_metric(spark, sf):
    df = d.klines_cleaned(spark, sf).withColumn("day", F.to_date("utc_datetime"))
    wide = shaping.pivot_metric(df, ["day"], "symbol", SYMBOLS, F.sum("number_of_trades"))
    return wide.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def q_unpivot_metric(spark, sf):
    return shaping.unpivot_metric(d.klines_cleaned(spark, sf), schemas.KEY, ["open", "high", "low", "close"])


QUERIES = {
    "cast_klines": q_cast_klines, "convert_timezone": q_convert_timezone, "cast_columns": q_cast_columns,
    "price_increase": q_price_increase, "select_features_target": q_select_features_target,
    "filter_since": q_filter_since, "drop_columns": q_drop_columns, "apply_threshold": q_apply_threshold,
    "drop_missing": q_drop_missing, "fill_missing": q_fill_missing, "dedupe_latest": q_dedupe_latest,
    "clip_outliers": q_clip_outliers, "drop_outliers_z": q_drop_outliers_z, "enrich_join": q_enrich_join,
    "aggregate_klines": q_aggregate_klines, "aggregate_lines": q_aggregate_lines, "rollup_candles": q_rollup_candles,
    "pivot_metric": q_pivot_metric, "unpivot_metric": q_unpivot_metric,
}

_K = f"with {d.KLINES_SQL}"
_PRICES = ("open", "high", "low", "close", "volume", "quote_asset_volume", "taker_buy_base_asset_volume",
           "taker_buy_quote_asset_volume")


def _typed(times: bool) -> str:
    cells = []
    for c in schemas.PAGE_COLUMNS:
        if c in _PRICES:
            cells.append(f"{c}::double as {c}")
        elif c in schemas.TIME_COLUMNS and times:
            cells.append(f"make_timestamp({c}*1000) as {c}")
        else:
            cells.append(c)
    return ", ".join(cells)


def _stats(columns: list[str]) -> str:
    return ", ".join(f"round({f}({c}),4) as {f}_{c}" if f in ("sum", "avg") else f"{f}({c}) as {f}_{c}"
                     for c in columns for f in ("sum", "avg", "max", "min"))


_GAPPED = f"""select symbol, open_time, case when open_time // {d.HOUR_MS} % 7 <> 0 then taker_buy_base_asset_volume end
  as taker_buy_base_asset_volume from cleaned"""
ORACLES = {
    "cast_klines": f"""{_K} select utc_datetime, symbol, {_typed(True)}, updated_at,
  utc_datetime + interval 8 hour as utc_singapore_datetime from stamped""",
    "convert_timezone": """select event_id, ts, ts + interval 8 hour as singapore, ts - interval 5 hour as new_york
from events""",
    "cast_columns": f"{_K} select utc_datetime, symbol, {_typed(False)}, updated_at from stamped",
    "price_increase": f"{_K} select symbol, open_time, open, close, price_increase from cleaned",
    "select_features_target": f"{_K} select symbol, open_time, {', '.join(schemas.FEATURES)}, price_increase from cleaned",
    "filter_since": f"select event_id, ts as utc_datetime, event_type, value from events where ts > timestamp '{d.SECOND_LOAD}'",
    "drop_columns": "select c_nationkey, c_acctbal, c_mktsegment from customer",
    "apply_threshold": f"with {d.SCORED_SQL} select event_id, y, (p >= 0.35e0)::int as y_pred from scored",
    "drop_missing": f"{_K} select * from ({_GAPPED}) where taker_buy_base_asset_volume is not null",
    "fill_missing": f"""{_K} select symbol, open_time,
  coalesce(taker_buy_base_asset_volume, -1e0) as taker_buy_base_asset_volume from ({_GAPPED})""",
    "dedupe_latest": """select * exclude (i) from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc,
           l_tax desc, l_returnflag desc, l_linestatus desc) as i from lineitem) where i = 1""",
    "clip_outliers": """with b as (select quantile_cont(value, 0.01) as lo, quantile_cont(value, 0.99) as hi from events)
select event_id, round(least(greatest(value, lo), hi), 6) as value from events, b""",
    "drop_outliers_z": """with b as (select avg(o_totalprice) as m, stddev_samp(o_totalprice) as s from orders)
select o_orderkey, o_totalprice from orders, b where abs(o_totalprice - m) <= 1.5e0 * s""",
    "enrich_join": """with u as (select user_id, count(*) as n, sum(value::decimal(18,2)) as v from events group by 1)
select c_mktsegment, count(*) as users, sum(n)::bigint as events, sum(v)::double as value
from u left join customer on user_id = c_custkey group by 1""",
    "aggregate_klines": f"""{_K} select symbol, {_stats(['close'])}, sum(number_of_trades)::bigint as sum_number_of_trades,
  round(avg(number_of_trades),4) as avg_number_of_trades, max(number_of_trades) as max_number_of_trades,
  min(number_of_trades) as min_number_of_trades from cleaned group by 1""",
    "aggregate_lines": f"select l_returnflag, l_linestatus, {_stats(['l_quantity', 'l_discount'])} from lineitem group by 1, 2",
    "rollup_candles": f"""{_K} select symbol, date_trunc('day', utc_datetime) as utc_datetime, arg_min(open, open_time) as open,
  max(high) as high, min(low) as low, arg_max(close, open_time) as close, sum(volume) as volume,
  sum(number_of_trades)::bigint as number_of_trades, count(*) as candles from cleaned group by 1, 2""",
    "pivot_metric": f"""{_K} select strftime(utc_datetime, '%Y-%m-%d') as day, """ + ", ".join(
        f"sum(number_of_trades) filter (symbol = '{s}')::bigint as {s}" for s in SYMBOLS) + " from cleaned group by 1",
    "unpivot_metric": f"""{_K} """ + " union all ".join(
        f"select symbol, open_time, '{c}' as metric, {c} as value from cleaned" for c in ("open", "high", "low", "close")),
}
