"""Bias and variance over repeated predictions of the same rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bias_variance_summary(predictions: DataFrame, truth: DataFrame, loss: str = "0-1_loss") -> DataFrame:
    """Expected loss, bias and variance of (round, test_id, pred) against (test_id, y).

    0-1 loss: the main prediction of a row is its most frequent class, the lowest on ties. mse: the mean.
    """
    if loss not in ("0-1_loss", "mse"):
        raise ValueError(f"loss must be 0-1_loss or mse, not {loss}")
    if loss == "0-1_loss":
        # Counted per class first: where the rounds of a row come from one task, its votes collapse before any shuffle.
        votes = predictions.groupBy("test_id", "pred").agg(F.count("*").alias("n"))
        rows = votes.join(truth, "test_id").groupBy("test_id").agg(
            F.min(F.struct((-F.col("n")).alias("n"), "pred")).alias("top"), F.first("y").alias("y"),
            F.sum("n").alias("n"), F.sum(F.when(F.col("pred") != F.col("y"), F.col("n")).otherwise(F.lit(0))).alias("wrong"))
        main = rows.select((F.col("top.pred") != F.col("y")).cast("double").alias("bias"),
                           (F.lit(1.0) + F.col("top.n") / F.col("n")).alias("variance"),
                           (F.col("wrong") / F.col("n")).alias("loss"))
    else:
        # Summed up to one row of each test row before the truth is joined. The mean of (pred - y)^2 is the variance plus (mean - y)^2,
        # but infinite where a prediction is, whose variance is unknown.
        votes = predictions.groupBy("test_id").agg(
            F.avg("pred").alias("main"), F.var_pop("pred").alias("variance"), F.max(F.abs("pred")).alias("most"))
        off = F.pow(F.col("main") - F.col("y"), F.lit(2.0))
        loss = F.when(F.col("y").isNotNull() & (F.col("most") == F.lit(math.inf)), F.lit(math.inf)).otherwise(F.col("variance") + off)
        rows = votes.join(truth, "test_id").groupBy("test_id").agg(
            F.first("main").alias("main"), F.first("variance").alias("variance"), F.first("y").alias("y"), F.avg(loss).alias("loss"))
        main = rows.select(F.pow(F.col("main") - F.col("y"), F.lit(2.0)).alias("bias"), "variance", "loss")
    return main.agg(F.avg("loss").alias("expected_loss"), F.avg("bias").alias("bias"), F.avg("variance").alias("variance"))
