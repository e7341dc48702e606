"""Epoch milliseconds, wall clocks and zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(epoch_ms: Column) -> Column:
    """UTC wall clock of an epoch-millisecond column (the session zone is UTC)."""
    return F.timestamp_millis(epoch_ms.cast("long")).cast("timestamp_ntz")


def epoch_ms(wall: Column) -> Column:
    """Epoch milliseconds of a UTC wall clock."""
    return F.unix_millis(wall.cast("timestamp"))


def in_zone(wall: Column, zone: str) -> Column:
    """The wall clock that ``zone`` shows when UTC shows ``wall``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), wall.cast("timestamp_ntz"))
