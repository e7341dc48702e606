"""Declared table layouts. The column lists are fixed values of the candle feed."""

from __future__ import annotations

from pyspark.sql import types as T

# The twelve positions of one candle in a feed page.
PAGE_COLUMNS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_asset_volume", "number_of_trades", "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume", "ignore",
]
PAGE_INTEGERS = ["open_time", "close_time", "number_of_trades"]

# Default casts, features and target.
TIME_COLUMNS = ["open_time", "close_time"]
FLOAT_COLUMNS = [
    "open", "high", "low", "close", "volume", "quote_asset_volume",
    "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume",
]
FEATURES = [
    "open", "high", "low", "volume", "number_of_trades",
    "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume",
]
TARGET = "price_increase"

KEY = ["symbol", "open_time"]

TYPES = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "bool": T.BooleanType(),
    "datetime": T.TimestampNTZType(),
}


def struct_of(declared: dict[str, str]) -> T.StructType:
    """Spark schema of a declared layout; an unknown logical type is an error."""
    unknown = sorted(set(declared.values()) - set(TYPES))
    if unknown:
        raise ValueError(f"no table type for {unknown}")
    return T.StructType([T.StructField(name, TYPES[kind], True) for name, kind in declared.items()])


def _page_types(integers: str, others: str) -> dict[str, str]:
    return {c: integers if c in TIME_COLUMNS else "int" if c == "number_of_trades"
            else "str" if c == "ignore" else others for c in PAGE_COLUMNS}


RAW = {"utc_datetime": "datetime", **_page_types("int", "str"), "updated_at": "datetime"}
TRANSFORMED = {"utc_datetime": "datetime", **_page_types("datetime", "float"), "updated_at": "datetime",
               "utc_singapore_datetime": "datetime"}
CLEANED = {"utc_datetime": "datetime", **_page_types("int", "float"), "updated_at": "datetime",
           "price_increase": "int"}
SCORING_REQUEST = {c: "int" if c == "number_of_trades" else "float" for c in FEATURES}
