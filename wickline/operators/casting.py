"""Casts, projections and scalar derivations on candle tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline import schemas
from wickline.functions.clock import in_zone, wall_clock


def stamp_lineage(pages: DataFrame, run_ts: datetime) -> DataFrame:
    """Candle time first, run time last. The run time is an argument, never the clock."""
    stamp = F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return pages.select(wall_clock(F.col("open_time")).alias("utc_datetime"), "*", stamp.alias("updated_at"))


def _as_wall_clock(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return wall_clock(F.col(name)) if kind in ("bigint", "int") else F.col(name).cast("timestamp_ntz")


def cast_klines(
    df: DataFrame,
    datetime_column: str = "utc_datetime",
    zone_column: str = "utc_singapore_datetime",
    zone: str = "Asia/Singapore",
    time_columns: list[str] = schemas.TIME_COLUMNS,
    float_columns: list[str] = schemas.FLOAT_COLUMNS,
) -> DataFrame:
    """Raw candle rows to typed ones: one projection, no shuffle."""

    def typed(name: str) -> Column:
        if name in time_columns or name == datetime_column:
            return _as_wall_clock(df, name).alias(name)
        return F.col(name).cast("double").alias(name) if name in float_columns else F.col(name)

    zoned = in_zone(_as_wall_clock(df, datetime_column), zone).alias(zone_column)
    return df.select(*[typed(c) for c in df.columns if c != zone_column], zoned)


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Cast the named columns; ``strict=False`` turns bad values into NULL instead of failing."""
    def one(name: str) -> Column:
        if name not in types:
            return F.col(name)
        return (F.col(name).cast if strict else F.col(name).try_cast)(types[name]).alias(name)

    return df.select(*[one(c) for c in df.columns])


# The default casts of the cleaning step.
CLEANING_TYPES = {
    "utc_datetime": "timestamp_ntz", "open_time": "bigint", "open": "double", "high": "double",
    "low": "double", "close": "double", "volume": "double", "close_time": "bigint",
    "quote_asset_volume": "double", "number_of_trades": "bigint",
    "taker_buy_base_asset_volume": "double", "taker_buy_quote_asset_volume": "double",
    "ignore": "string", "updated_at": "timestamp_ntz",
}


def convert_timezone(df: DataFrame, source: str, target: str, zone: str) -> DataFrame:
    return df.withColumn(target, in_zone(F.col(source), zone))


def with_price_increase(df: DataFrame, name: str = schemas.TARGET) -> DataFrame:
    """1 where the candle closed above its open, else 0 (a flat candle is 0)."""
    return df.withColumn(name, (F.col("close") > F.col("open")).cast("int"))


def select_features_target(df: DataFrame, features: list[str] = schemas.FEATURES,
                           target: str | list[str] = schemas.TARGET, keys: list[str] = ()) -> DataFrame:
    """Feature columns and one target, or several targets for a multi-label task."""
    targets = [target] if isinstance(target, str) else list(target)
    missing = [c for c in [*keys, *features, *targets] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    return df.select(*keys, *features, *targets)


def filter_since(df: DataFrame, since: str, column: str = "utc_datetime") -> DataFrame:
    """Rows strictly after a UTC literal; a plain comparison, so it reaches the file scan."""
    return df.where(F.col(column) > F.lit(since).cast("timestamp_ntz"))


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def apply_threshold(df: DataFrame, threshold: float, score: str = "p", name: str = "y_pred") -> DataFrame:
    """1 where the score reaches the threshold."""
    return df.withColumn(name, (F.col(score) >= F.lit(float(threshold))).cast("int"))
