"""Model performance on live data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.operators.monitoring import row_metrics


def match_labels(predictions: DataFrame, labels: DataFrame, key: str, wait: str, lateness: str) -> DataFrame:
    """Predictions (key, ts, p, y_pred) joined to labels (key, label_ts, y) that arrive up to ``wait`` later.

    Watermarks on both sides and the time range bound the state to one waiting period.
    """
    left = predictions.withWatermark("ts", lateness)
    right = labels.withColumnRenamed(key, "__key").withWatermark("label_ts", lateness)
    near = (F.col(key) == F.col("__key")) & (F.col("label_ts") >= F.col("ts")) & (
        F.col("label_ts") <= F.col("ts") + F.expr(f"interval {wait}"))
    return left.join(right, near).drop("__key")


def windowed_performance(matched: DataFrame, time: str = "ts", width: str = "1 day") -> DataFrame:
    """Metrics per tumbling window of a matched stream or table."""
    return matched.groupBy(F.window(time, width).alias("w")).agg(*row_metrics()).select(
        F.col("w.start").alias("window_start"), "rows", "accuracy", "log_loss", "brier_score")


def monitor_stream(scored: DataFrame, lateness: str, width: str = "1 day") -> DataFrame:
    """Metrics of a scored stream; a window is emitted once, after its last possible row."""
    return windowed_performance(scored.withWatermark("ts", lateness), "ts", width)
