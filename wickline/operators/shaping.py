"""Cleaning, joining, aggregating and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.operators.running import exact_quantiles
from wickline.small import broadcast_table_if_small


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where none of the columns is NULL or NaN."""
    kinds = dict(df.dtypes)
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
        if kinds[c] in ("double", "float"):
            present = present & ~F.isnan(c)
    return df.where(present)


def fill_missing(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, remaining columns breaking ties.

    An aggregate, not a window: copies of one key collapse inside every map task, so a key
    that holds a large share of the rows never gathers in one place.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("best")
    return df.groupBy(*keys).agg(best).select(*[c if c in keys else F.col(f"best.{c}").alias(c) for c in df.columns])


def clip_outliers(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99,
                  by: str | None = None) -> DataFrame:
    """Pull values outside the exact quantile range to its ends (fit, then a projection)."""
    bounds = {r["column"]: r for r in exact_quantiles(df, columns, [low, high]).collect()}
    clipped = {c: F.least(F.greatest(F.col(c), F.lit(bounds[c]["q0"])), F.lit(bounds[c]["q1"])) for c in columns}
    return df.withColumns(clipped)


def drop_outliers_z(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Rows within ``limit`` sample standard deviations of the mean in every column."""
    one = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.abs(F.col(c) - F.lit(one[f"m_{c}"])) <= F.lit(limit * (one[f"s_{c}"] or 0.0)))
    return df.where(keep)


def enrich_join(df: DataFrame, other: DataFrame, on: list[tuple[str, str]], columns: Sequence[str],
                how: str = "left") -> DataFrame:
    """Add columns of another table. Its size is counted before it may be broadcast."""
    side = other.select(*[F.col(r).alias(f"__{r}") for _, r in on], *columns)
    side = broadcast_table_if_small(side)
    match = F.lit(True)
    for left, right in on:
        match = match & (F.col(left) == F.col(f"__{right}"))
    return df.join(side, match, how).drop(*[f"__{r}" for _, r in on])


def aggregate_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum, mean, maximum and minimum of every measure per group."""
    parts = [("sum", F.sum), ("avg", F.avg), ("max", F.max), ("min", F.min)]
    return df.groupBy(*keys).agg(*[f(m).alias(f"{n}_{m}") for m in measures for n, f in parts])


def rollup_candles(candles: DataFrame, unit: str, keys: Sequence[str] = ("symbol",),
                   time: str = "utc_datetime") -> DataFrame:
    """Coarser candles: first open, last close, extremes and totals per unit of time."""
    slot = F.date_trunc(unit, F.col(time)).cast("timestamp_ntz").alias(time)
    return candles.groupBy(*keys, slot).agg(
        F.min_by("open", "open_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "open_time").alias("close"), F.sum("volume").alias("volume"),
        F.sum("number_of_trades").alias("number_of_trades"), F.count("*").alias("candles"))


def pivot_metric(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], measure: Column) -> DataFrame:
    """One column per listed value; the list is given, so no extra pass looks for it. A value that is not listed, or a
    missing one, is an error when the rows are read, as its rows would vanish."""
    refuse = F.raise_error(F.concat(F.lit(f"{column} is not listed: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL"))))
    listed = F.when(F.col(column).isin(list(values)), F.col(column)).otherwise(refuse.cast(df.schema[column].dataType))
    return df.withColumn(column, listed).groupBy(*rows).pivot(column, list(values)).agg(measure)


def unpivot_metric(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "metric",
                   value: str = "value") -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)
