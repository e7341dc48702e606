"""Scoring with the deployed model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.operators import registry
from wickline.operators.scoring import batch_score
from wickline.plans.training import REGISTRY_TYPES


def production_model(spark: SparkSession, root: str, name: str) -> tuple[PipelineModel, str]:
    """The latest production model of a name and its signature."""
    known = spark.read.schema(REGISTRY_TYPES).parquet(f"{root}/registry").where(F.col("name") == name)
    row = registry.latest_production_model(known).first()
    if row is None:
        raise ValueError(f"no production model named {name}")
    path = f"{root}/models/{row['run_id']}"
    return registry.load_model(path), registry.load_signature(path)


def serve(records: DataFrame, root: str, name: str, keys: Sequence[str]) -> DataFrame:
    """Score a table or a stream of records with the production model."""
    model, signature = production_model(records.sparkSession, root, name)
    return batch_score(model, records, keys, signature)
