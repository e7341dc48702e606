"""Checked handling of summaries that are expected to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 20_000


def fetch_if_small(df: DataFrame, max_rows: int = SMALL_ROWS):
    """The rows of ``df``, or None when there are more than ``max_rows`` of them."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def broadcast_table_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast a stored dimension table when its row count (read from footers) allows it."""
    return F.broadcast(df) if df.count() <= max_rows else df
