"""Inputs that several queries share, built from the given tables by Spark and, as text, by DuckDB."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.operators.casting import cast_columns, cast_klines, stamp_lineage, with_price_increase
from wickline.streaming.candles import build_candles

RUN_TS = datetime(2024, 2, 1)
HOUR_MS = 3_600_000
SECOND_LOAD = "2024-01-15 00:00:00"  # candles from here on arrive with the second load
SECOND_LOAD_MS = 1_705_276_800_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ticks(events: DataFrame) -> DataFrame:
    """Events as trades: type is the symbol, value the price, ``k`` of the properties the quantity."""
    return events.select(
        F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("tick_id"),
        F.col("value").cast("decimal(18,2)").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("quantity"),
        (F.col("user_id") % 2 == 0).alias("taker_buy"))


def klines_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly candles in the raw layout: times in epoch milliseconds, prices and volumes as text."""
    return build_candles(ticks(table(spark, sf, "events")), "hour", HOUR_MS)


def klines_stamped(spark: SparkSession, sf: str) -> DataFrame:
    return stamp_lineage(klines_raw(spark, sf), RUN_TS)


def klines_typed(spark: SparkSession, sf: str) -> DataFrame:
    return cast_klines(klines_stamped(spark, sf))


def klines_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Candles ready for training: numbers and the direction target."""
    numbers = {c: "double" for c in ("open", "high", "low", "close", "volume", "quote_asset_volume",
                                     "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume")}
    return with_price_increase(cast_columns(klines_stamped(spark, sf), numbers))


def keyed_klines(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned candles with one text key."""
    return klines_cleaned(spark, sf).withColumn("key", F.concat_ws("@", "symbol", "open_time"))


def numbered_klines(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned candles with one whole-number key: the hour and the symbol's letter code."""
    code = F.ascii("symbol") * 1000 + F.ascii(F.substring("symbol", 2, 1))
    return klines_cleaned(spark, sf).withColumn("id", F.col("open_time") / HOUR_MS * 1_000_000 + code).withColumn(
        "id", F.col("id").cast("bigint"))


def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    """Two-class scored frame over all events."""
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.col("event_type").isin("error", "signup").cast("int").alias("y"),
        (F.col("value") / F.lit(600.0)).alias("p"),
        (F.col("value") / F.lit(600.0) >= F.lit(0.4)).cast("int").alias("y_pred"))


FLAGS = {"A": "p_a", "N": "p_n", "R": "p_r"}


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Three-class scored frame over all order lines; probabilities are shares of three weights."""
    a = F.lit(1.0) + F.col("l_quantity") / F.lit(50.0)
    n = F.lit(1.0) + F.col("l_discount") * F.lit(10.0)
    r = F.lit(1.0) + F.col("l_tax") * F.lit(10.0)
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate", F.col("l_returnflag").alias("y"),
        (a / (a + n + r)).alias("p_a"), (n / (a + n + r)).alias("p_n"), (r / (a + n + r)).alias("p_r"))
    top = F.greatest("p_a", "p_n", "p_r")
    pred = F.when(F.col("p_a") == top, "A").when(F.col("p_n") == top, "N").otherwise("R")
    return df.withColumn("y_pred", pred)


KLINES_SQL = """
e as (select event_type as symbol, date_trunc('hour', ts) as t0, ts, event_id, user_id,
             cast(value as decimal(18,2)) as px, cast(regexp_extract(props,'([0-9]+)',1) as bigint) as qty
      from events),
klines as (
  select symbol, epoch_ms(t0) as open_time,
    cast(arg_min(px, (ts,event_id)) as varchar) as open, cast(max(px) as varchar) as high,
    cast(min(px) as varchar) as low, cast(arg_max(px, (ts,event_id)) as varchar) as close,
    cast(sum(qty) as varchar) as volume, epoch_ms(t0) + 3599999 as close_time,
    cast(sum(px*qty) as varchar) as quote_asset_volume, count(*) as number_of_trades,
    cast(sum(case when user_id % 2 = 0 then qty else 0 end) as varchar) as taker_buy_base_asset_volume,
    cast(sum(case when user_id % 2 = 0 then px*qty else 0 end) as varchar) as taker_buy_quote_asset_volume,
    '0' as ignore
  from e group by symbol, t0),
stamped as (select make_timestamp(open_time*1000) as utc_datetime, *, timestamp '2024-02-01' as updated_at from klines),
cleaned as (
  select symbol, utc_datetime, open_time, open::double as open, high::double as high, low::double as low,
    close::double as close, volume::double as volume, close_time, quote_asset_volume::double as quote_asset_volume,
    number_of_trades, taker_buy_base_asset_volume::double as taker_buy_base_asset_volume,
    taker_buy_quote_asset_volume::double as taker_buy_quote_asset_volume, ignore, updated_at,
    (close::double > open::double)::int as price_increase,
    symbol || '@' || open_time::varchar as key,
    (open_time // 3600000) * 1000000 + ascii(symbol) * 1000 + ascii(substr(symbol,2,1)) as id
  from stamped)
"""

SCORED_SQL = """
scored as (select event_id, ts, user_id, event_type, (event_type in ('error','signup'))::int as y,
                  value / 600e0 as p, (value / 600e0 >= 0.4e0)::int as y_pred from events)
"""

LINES_SQL = """
w as (select l_orderkey, l_linenumber, l_linestatus, l_shipdate, l_returnflag as y, 1e0 + l_quantity / 50e0 as a,
             1e0 + l_discount * 10e0 as n, 1e0 + l_tax * 10e0 as r from lineitem),
probs as (select l_orderkey, l_linenumber, l_linestatus, l_shipdate, y, a/(a+n+r) as p_a, n/(a+n+r) as p_n,
                 r/(a+n+r) as p_r from w),
lines as (select *, case when p_a = greatest(p_a,p_n,p_r) then 'A' when p_n = greatest(p_a,p_n,p_r) then 'N'
                         else 'R' end as y_pred from probs)
"""


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Fractions as the comparison sees them: six digits, no negative zero."""
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if k in ("double", "float") else F.col(c)
                       for c, k in df.dtypes])


def md5_int(text: str) -> str:
    """DuckDB twin of the leading eight hex digits as a number."""
    return f"('0x' || substr(md5({text}),1,8))::bigint"
