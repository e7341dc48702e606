"""Candle interval texts such as ``1m``, ``2h`` and ``3d``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PATTERN = r"^([+-]?[0-9]+)([mhd])$"
_UNIT_MS = {"m": 60_000, "h": 3_600_000, "d": 86_400_000}


def try_interval_to_millis(interval: Column) -> Column:
    """Milliseconds of an interval text, NULL where the text is not an interval."""
    unit = F.regexp_extract(interval, _PATTERN, 2)
    factor = F.when(unit == "m", F.lit(_UNIT_MS["m"]).cast("long"))
    factor = factor.when(unit == "h", F.lit(_UNIT_MS["h"]).cast("long"))
    factor = factor.when(unit == "d", F.lit(_UNIT_MS["d"]).cast("long"))
    return F.regexp_extract(interval, _PATTERN, 1).try_cast("long") * factor


def interval_to_millis(interval: Column) -> Column:
    """As :func:`try_interval_to_millis`, but an invalid text fails the query."""
    millis = try_interval_to_millis(interval)
    refuse = F.raise_error(F.concat(F.lit("Invalid interval format: "), interval))
    return F.when(interval.isNull(), F.lit(None).cast("long")).otherwise(F.coalesce(millis, refuse.cast("long")))


def millis_of(interval: str) -> int:
    """Driver-side form for a job parameter."""
    number, unit = interval[:-1], interval[-1:]
    if unit not in _UNIT_MS:
        raise ValueError(f"Invalid interval format: {interval}")
    return int(number) * _UNIT_MS[unit]
