"""Runs, versions and stages kept as append-only tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.sources.paths import create_once

PRODUCTION, STAGING, ARCHIVED = "Production", "Staging", "Archived"


def log_metrics(run: str, step: int | None, wide: DataFrame) -> DataFrame:
    """Metric columns of one row as (run_id, name, step, value) rows, ready to append."""
    rows = wide.unpivot([], wide.columns, "name", "value")
    return rows.select(F.lit(run).alias("run_id"), "name", F.lit(step).cast("int").alias("step"),
                       F.col("value").cast("double").alias("value"))


def log_params(run: str, wide: DataFrame) -> DataFrame:
    """Parameter columns of one row as (run_id, name, value) texts, ready to append; a missing value stays missing."""
    texts = wide.select(*[F.col(c).cast("string").alias(c) for c in wide.columns])
    return texts.unpivot([], texts.columns, "name", "value").select(F.lit(run).alias("run_id"), "name", "value")


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The value at the last step of each metric of each run (the greater value if a step was logged twice)."""
    last = F.max(F.struct("step", "value")).alias("last")
    return metrics.groupBy("run_id", "name").agg(last).select("run_id", "name", "last.step", "last.value")


def next_version(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates (name, run_id) with the version each would get."""
    newest = registry.groupBy("name").agg(F.max("version").alias("top"))
    return candidates.join(newest, "name", "left").select(
        *candidates.columns, (F.coalesce("top", F.lit(0)) + 1).alias("version"))


def claim_version(spark: SparkSession, root: str, name: str, run_id: str, first: int = 1,
                  tags: Mapping[str, str] | None = None) -> int:
    """Take the lowest free version of a name, from ``first`` on, for a run: each version is a file that one run makes.

    Two runs at once get two versions. A run that asks again gets the version that it has. The file holds the
    run's id and its tags.
    """
    claim = json.dumps({"run_id": run_id, "tags": dict(tags or {})}, sort_keys=True)
    version = first
    while not create_once(spark, _claim(root, name, version), claim):
        taken = spark.read.text(_claim(root, name, version), wholetext=True).first()
        if taken is not None and taken["value"] == claim:
            break
        version += 1
    return version


def _claim(root: str, name: str, version: int) -> str:
    return f"{root}/claims/{name.encode().hex()}/{version}.json"


def version_tags(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(version, run_id, tag, value) of every claimed version; one row with missing tag where a version has none."""
    claims = spark.read.schema("run_id string, tags map<string, string>").option("mode", "FAILFAST").json(f"{root}/claims/{name.encode().hex()}")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("int")
    return claims.select(number.alias("version"), "run_id", F.explode_outer("tags").alias("tag", "value"))


def current_stage(registry: DataFrame) -> DataFrame:
    """The latest stage of every (name, version); the later run id wins within one instant."""
    last = F.max(F.struct("changed_at", "run_id", "stage")).alias("last")
    return registry.groupBy("name", "version").agg(last).select(
        "name", "version", "last.stage", "last.run_id", "last.changed_at")


def transition_stage(registry: DataFrame, changes: DataFrame) -> DataFrame:
    """Append stage changes; the history stays."""
    return registry.unionByName(changes.select(*registry.columns))


def latest_in_stage(registry: DataFrame, stage: str) -> DataFrame:
    """Highest version of each name that is in the given stage now."""
    now = current_stage(registry).where(F.col("stage") == stage)
    return now.groupBy("name").agg(F.max(F.struct("version", "run_id")).alias("m")).select(
        "name", "m.version", "m.run_id")


def latest_production_model(registry: DataFrame) -> DataFrame:
    return latest_in_stage(registry, PRODUCTION)


def promotion_decision(candidates: DataFrame, production: DataFrame) -> DataFrame:
    """Promote a candidate (name, version, value) if nothing is deployed or it is strictly better."""
    live = production.select("name", F.col("version").alias("live_version"), F.col("value").alias("live_value"))
    better = F.col("live_version").isNull() | (F.col("value") > F.col("live_value"))
    return candidates.join(live, "name", "left").select(
        "name", "version", "value", "live_version", "live_value", F.coalesce(better, F.lit(False)).alias("promote"))


def compare_metrics(first: DataFrame, second: DataFrame, keys: Sequence[str] = ("name",),
                    smaller_is_better: Sequence[str] = ("loss", "brier_score")) -> DataFrame:
    """Metric by metric: both values, difference, ratio and the winner."""
    a = first.select(*keys, F.col("value").alias("a"))
    b = second.select(*keys, F.col("value").alias("b"))
    lower = F.col("name").isin(*smaller_is_better)
    lead = F.when(lower, F.col("b") - F.col("a")).otherwise(F.col("a") - F.col("b"))
    winner = F.when(lead > 0, "a").when(lead < 0, "b").otherwise("tie")
    return a.join(b, list(keys)).select(*keys, "a", "b", (F.col("a") - F.col("b")).alias("delta"),
                                        F.try_divide(F.col("a"), F.col("b")).alias("ratio"), winner.alias("winner"))


def signature_of(inputs: DataFrame, outputs: DataFrame) -> str:
    """Input and output layout of a model as JSON."""
    return json.dumps({"inputs": json.loads(inputs.schema.json()), "outputs": json.loads(outputs.schema.json())})


def check_signature(df: DataFrame, signature: str) -> list[str]:
    """What keeps a frame from being scored: absent columns and columns of another type."""
    wanted = T.StructType.fromJson(json.loads(signature)["inputs"])
    have = {f.name: f.dataType for f in df.schema.fields}
    absent = [f"missing column {f.name}" for f in wanted.fields if f.name not in have]
    return absent + [f"column {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}"
                     for f in wanted.fields if f.name in have and have[f.name] != f.dataType]


def save_model(model: PipelineModel, path: str, signature: str | None = None) -> None:
    model.write().save(path)
    if signature is not None:
        spark = SparkSession.active()
        spark.createDataFrame([(signature,)], "value string").coalesce(1).write.text(f"{path}-signature")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_signature(path: str) -> str:
    return SparkSession.active().read.text(f"{path}-signature").first()["value"]
