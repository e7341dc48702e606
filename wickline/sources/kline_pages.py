"""Request windows for a candle feed and the pages they return."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline import schemas
from wickline.functions.intervals import interval_to_millis, millis_of


def plan_pages(symbols: DataFrame, interval: str | None = None, limit: int = 1000) -> DataFrame:
    """One row per request window of every (symbol, start_time, end_time), half open, end clipped.

    The interval is one for all symbols, or the column ``interval`` of the table.
    """
    text = F.lit(interval) if interval else F.col("interval")
    named = symbols.withColumn("interval", text)
    width = interval_to_millis(F.col("interval")) * F.lit(limit)
    span = F.col("end_time") - F.col("start_time")
    last = F.greatest(F.ceil(span / width) - 1, F.lit(0)).cast("long")
    pages = named.withColumn("__width", width).withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("start_time") + F.col("page") * F.col("__width")
    stop = F.least(start + F.col("__width"), F.col("end_time"))
    return pages.select("symbol", "interval", "page", start.alias("start_time"), stop.alias("end_time"),
                        F.lit(limit).alias("limit"))


def write_kline_pages(candles: DataFrame, path: str, interval: str, limit: int = 1000,
                      mode: str = "errorifexists") -> None:
    """Land candles the way the feed delivers them: JSON arrays of at most ``limit`` arrays.

    A page covers ``limit`` intervals, so the rows gathered into it are bounded.
    """
    width = millis_of(interval) * limit
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, r'(["\\\\])', r"\\$1"), F.lit('"'))
    cells = [F.coalesce(F.col(c).cast("string") if c in schemas.PAGE_INTEGERS else quoted(F.col(c)), F.lit("null"))
             for c in schemas.PAGE_COLUMNS]
    row = F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))
    keyed = candles.select("symbol", F.floor(F.col("open_time") / width).alias("page"), "open_time", row.alias("row"))
    pages = keyed.groupBy("symbol", "page").agg(
        F.array_sort(F.collect_list(F.struct("open_time", "row"))).alias("rows"))
    text = F.concat(F.lit("["), F.array_join(F.col("rows.row"), ","), F.lit("]"))
    pages.select(text.alias("value"), "symbol").write.mode(mode).partitionBy("symbol").text(path)


def parse_kline_pages(pages: DataFrame) -> DataFrame:
    """Page texts to rows: twelve named columns, times and counts as numbers, the rest as text.

    A page that is not an array of arrays of twelve cells fails the job, so no row is lost; blank lines are no pages.
    """
    parsed = F.from_json("value", "array<array<string>>")
    wide = F.forall(parsed, lambda r: F.coalesce(F.size(r) == len(schemas.PAGE_COLUMNS), F.lit(False)))
    broken = F.raise_error(F.concat(F.lit("not a page of candles: "), F.substring("value", 1, 200))).cast("array<array<string>>")
    rows = F.when(F.trim("value", F.lit(" \t\r\n")) == "", None).when(F.coalesce(wide, F.lit(False)), parsed).otherwise(broken)
    typed = F.transform(rows, lambda r: F.struct(*[
        (F.get(r, i).cast("long") if c in schemas.PAGE_INTEGERS else F.get(r, i)).alias(c)
        for i, c in enumerate(schemas.PAGE_COLUMNS)]))
    others = [c for c in pages.columns if c != "value"]
    return pages.select(*others, F.inline(typed))


def read_kline_pages(spark: SparkSession, path: str, page_per_file: bool = False,
                     landed_after: datetime | None = None) -> DataFrame:
    """Every landed page below ``path``; all pages are one scan, so reading is their union.

    Pages are lines, or whole files when a page was landed over several lines. ``landed_after`` (UTC) leaves
    out files written earlier: they are dropped from the listing and never opened.
    """
    reader = spark.read
    if landed_after is not None:
        reader = reader.option("modifiedAfter", f"{landed_after:%Y-%m-%dT%H:%M:%S}").option("timeZone", "UTC")
    return parse_kline_pages(reader.text(path, wholetext=page_per_file))
