"""Scoring of batches and streams, and checks of what came out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.operators.registry import check_signature


def batch_score(model: PipelineModel, records: DataFrame, keys: Sequence[str], signature: str | None = None) -> DataFrame:
    """Predicted class and the probability of every class; records may be a stream."""
    if signature is not None:
        problems = check_signature(records, signature)
        if problems:
            raise ValueError("; ".join(problems))
    return model.transform(records).select(*keys, F.col("prediction").cast("int").alias("prediction"),
                                           vector_to_array("probability").alias("probability"))


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def linear_score(df: DataFrame, weights: dict[str, float], bias: float, name: str = "p") -> DataFrame:
    """Probability under fixed coefficients: one expression inside the scan stage."""
    margin = F.lit(float(bias))
    for c, w in weights.items():
        margin = margin + F.lit(float(w)) * F.col(c)
    return df.withColumn(name, logistic(margin))


def score_checks(scored: DataFrame, probabilities: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """Rows breaking each rule of a scored frame, one row per rule."""
    known = [c for c in [*probabilities, prediction] if c in scored.columns]
    absent = len(probabilities) + 1 - len(known)
    probs = [c for c in probabilities if c in known]
    total = sum((F.col(c) for c in probs), F.lit(0.0))
    out_of_range = F.lit(False)
    nothing = F.lit(False)
    for c in probs:
        out_of_range = out_of_range | ~F.col(c).between(0.0, 1.0)
    for c in known:
        nothing = nothing | F.col(c).isNull()
    one = scored.agg(F.count_if(nothing).alias("null_output"), F.count_if(out_of_range).alias("probability_range"),
                     F.count_if(F.abs(total - 1.0) > 1e-9).alias("probability_sum"))
    rules = [F.struct(F.lit("missing_columns").alias("rule"), F.lit(absent).cast("bigint").alias("failures"))]
    rules += [F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in one.columns]
    return one.select(F.inline(F.array(*rules))).withColumn("passed", F.col("failures") == 0)
