"""A whole training run: from the candle table to a registered and possibly promoted model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline import schemas
from wickline.operators import biasvariance, casting, metrics, models, quality, ranking, registry, resampling
from wickline.operators.features import preprocess_chain
from wickline.session import settled
from wickline.sources import snapshots


@dataclass(frozen=True)
class TrainingSettings:
    """Parameters of a run; the defaults are the customary ones."""

    name: str = "direction"
    since: str = "2023-06-09 00:00:00"
    rows: int = 3000
    seed: int = resampling.SEED
    trials: int = models.TRIALS
    monitor: str = "accuracy"
    bootstrap_rounds: int = 200


REGISTRY_TYPES = "name string, version int, run_id string, stage string, changed_at timestamp_ntz"


def _registry(spark, root: str) -> DataFrame:
    from wickline.sources.paths import path_exists

    path = f"{root}/registry"
    return spark.read.schema(REGISTRY_TYPES).parquet(path) if path_exists(spark, path) else spark.createDataFrame(
        [], REGISTRY_TYPES)


def _append(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").parquet(path)


def extract_training_rows(candles: DataFrame, settings: TrainingSettings) -> DataFrame:
    """The newest candles since a date, checked, cast and labelled."""
    # Written once: the checks and the later stages would each build the candles again.
    recent = settled(ranking.latest_n(casting.filter_since(candles, settings.since), settings.rows, keys=["symbol"]), "recent-rows")
    quality.ensure_valid(quality.validate_frame(recent, schemas.RAW))
    cleaned = casting.with_price_increase(casting.cast_columns(recent, casting.CLEANING_TYPES))
    quality.ensure_valid(quality.validate_frame(cleaned, schemas.CLEANED))
    return cleaned.withColumn("key", F.concat_ws("@", "symbol", "open_time"))


def run_training(candles: DataFrame, root: str, settings: TrainingSettings, run_ts: datetime) -> dict:
    """Run every stage; tables and the model are stored under ``root``."""
    spark, run_id = candles.sparkSession, f"{run_ts:%Y%m%dT%H%M%S}"
    data = settled(extract_training_rows(candles, settings), "training-rows")
    mark = snapshots.save_version(data, root, settings.name, run_ts)
    split = settled(resampling.stratified_split(data, "key", schemas.TARGET, seed=settings.seed), "training-split")
    train = split.where("split = 'train'")
    chain = preprocess_chain(train, schemas.FEATURES)
    ready = settled(chain.transform(split).select("key", "split", "features", schemas.TARGET), "training-ready")
    part = {s: ready.where(F.col("split") == s) for s in ("train", "val", "test")}

    trials, best = models.tune(part["train"], part["val"], settings.trials, settings.monitor, settings.seed)
    trials.write.mode("overwrite").parquet(f"{root}/trials/{run_id}")
    model = models.retrain(part["train"], best)
    wide = {p: metrics.overall_metrics(models.scored(model, part[s]), prefix=p)
            for p, s in (("train", "train"), ("holdout", "test"))}
    votes = models.bias_variance_fit(part["train"], part["test"], "key", settings.bootstrap_rounds, alpha=best["alpha"])
    truth = part["test"].select(F.col("key").alias("test_id"), F.col(schemas.TARGET).alias("y"))
    summary = biasvariance.bias_variance_summary(settled(votes, "votes"), truth)
    named = summary.select(*[F.col(c).alias(f"avg_{c}") for c in summary.columns])
    for table in (*wide.values(), named):
        _append(registry.log_metrics(run_id, 0, table), f"{root}/metrics")

    full = models.full_chain(chain, model)
    request = split.select(*schemas.FEATURES)
    registry.save_model(full, f"{root}/models/{run_id}", registry.signature_of(request, request.limit(0)))
    params = {**{k: v for k, v in vars(settings).items()}, **{f"best_{k}": v for k, v in best.items()}}
    _append(registry.log_params(run_id, spark.createDataFrame([{k: str(v) for k, v in params.items()}])), f"{root}/params")
    version, promoted = _register(spark, root, settings, run_id, run_ts)
    return {"run_id": run_id, "fingerprint": mark, "best": best, "version": version, "promoted": promoted}


def _register(spark, root: str, settings: TrainingSettings, run_id: str, run_ts: datetime) -> tuple[int, bool]:
    """Next free version in staging; to production if nothing is there or the monitored metric is better."""
    known = _registry(spark, root)
    candidate = registry.next_version(known, spark.createDataFrame([(settings.name, run_id)], "name string, run_id string"))
    scores = registry.latest_metrics(spark.read.parquet(f"{root}/metrics")).where(
        F.col("name") == f"holdout_{settings.monitor}").select("run_id", "value")
    live = registry.latest_production_model(known).join(scores, "run_id")
    row = registry.promotion_decision(candidate.join(scores, "run_id"), live).first()
    version = registry.claim_version(spark, root, settings.name, run_id, int(row["version"]),
                                     {"experiment": settings.name, "run_id": run_id, "monitor": settings.monitor})
    _append(registry.log_params(run_id, spark.createDataFrame([(version,)], "model_version int")), f"{root}/params")
    stage = registry.PRODUCTION if row["promote"] else registry.STAGING
    entries = [(settings.name, version, run_id, stage, run_ts)]
    if row["promote"] and row["live_version"] is not None:
        old = live.first()["run_id"]
        entries.append((settings.name, int(row["live_version"]), old, registry.ARCHIVED, run_ts))
    _append(spark.createDataFrame(entries, REGISTRY_TYPES), f"{root}/registry")
    return version, bool(row["promote"])
