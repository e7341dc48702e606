"""Candles from trades: the same aggregation for a table and for a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline import schemas
from wickline.functions.clock import epoch_ms


def with_measures(ticks: DataFrame) -> DataFrame:
    """Per-trade inputs of the candle totals, worked out once per trade.

    ``place`` orders trades by time and id in one decimal number: a fixed-width key keeps the aggregate
    hash-based, and its partial results are a few numbers per candle however many trades it has.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(18,0)")
    place = micros * F.lit(str(10**19)).cast("decimal(20,0)") + F.col("tick_id").cast("decimal(19,0)")
    timed = ticks.withColumns({"place": place, "amount": F.col("price") * F.col("quantity")})
    return timed.withColumns({c: F.when(F.col("taker_buy"), F.col(m)).otherwise(F.lit(0))
                              for c, m in (("bought", "quantity"), ("bought_amount", "amount"))})


def candle_measures() -> list[Column]:
    """Open, high, low, close and totals of one candle."""
    return [F.min_by("price", "place").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
            F.max_by("price", "place").alias("close"), F.sum("quantity").alias("volume"),
            F.sum("amount").alias("quote_asset_volume"), F.count("*").alias("number_of_trades"),
            F.sum("bought").alias("taker_buy_base_asset_volume"),
            F.sum("bought_amount").alias("taker_buy_quote_asset_volume")]


def as_raw_layout(candles: DataFrame, start: Column, interval_ms: int) -> DataFrame:
    """Aggregated candles in the feed's layout, with the symbol first."""
    opened = epoch_ms(start)
    cells = {"open_time": opened, "close_time": opened + F.lit(interval_ms - 1), "ignore": F.lit("0"),
             "number_of_trades": F.col("number_of_trades")}
    return candles.select("symbol", *[cells.get(c, F.col(c).cast("string")).alias(c) for c in schemas.PAGE_COLUMNS])


def build_candles(ticks: DataFrame, unit: str, interval_ms: int) -> DataFrame:
    """Candles of a table of trades (symbol, ts, tick_id, price, quantity, taker_buy)."""
    slot = F.date_trunc(unit, F.col("ts")).cast("timestamp_ntz").alias("slot")
    return as_raw_layout(with_measures(ticks).groupBy("symbol", slot).agg(*candle_measures()), F.col("slot"), interval_ms)


def stream_candles(ticks: DataFrame, width: str, interval_ms: int, lateness: str) -> DataFrame:
    """Candles of a stream of trades; each is emitted once, when no more trades can reach it.

    Trades later than ``lateness`` behind the newest one are the only ones a stream leaves out.
    """
    timed = with_measures(ticks).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    candles = timed.groupBy("symbol", F.window("ts", width).alias("w")).agg(*candle_measures())
    return as_raw_layout(candles, F.col("w.start"), interval_ms)
