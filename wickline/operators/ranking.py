"""Top rows, ranks and result tables of trials and cross-validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_n(df: DataFrame, n: int, time: str = "utc_datetime", keys: Sequence[str] = ()) -> DataFrame:
    """The n newest rows, keys breaking ties: each task keeps n rows, nothing is sorted whole."""
    return df.orderBy(F.col(time).desc(), *[F.col(k).asc() for k in keys]).limit(n)


def rank_trials(trials: DataFrame, loss: str = "loss", monitor: str = "accuracy", by: Sequence[str] = (),
                number: str = "trial") -> DataFrame:
    """Trials in order of loss, best first, with the best one by the monitored metric marked."""
    by_loss = Window.partitionBy(*by).orderBy(F.col(loss).asc(), F.col(number).asc())
    by_monitor = Window.partitionBy(*by).orderBy(F.col(monitor).desc(), F.col(number).asc())
    return trials.select("*", F.row_number().over(by_loss).alias("loss_rank"),
                         (F.row_number().over(by_monitor) == 1).alias("is_best"))


def rank_grid(results: DataFrame, model: str = "model", score: str = "mean_test_score") -> DataFrame:
    """Competition rank of each setting per model; parameter names lose their step prefix."""
    w = Window.partitionBy(model).orderBy(F.col(score).desc())
    shown = results.withColumn("rank_test_score", F.rank().over(w))
    return shown.withColumn("param", F.substring_index("param", "__", -1)) if "param" in results.columns else shown


def best_per_model(results: DataFrame, model: str = "model", score: str = "mean_test_score",
                   tie: str = "param") -> DataFrame:
    """The best-scored row of each model, the smallest parameter text on ties."""
    rest = [c for c in results.columns if c not in (model, score, tie)]
    top = results.groupBy(model).agg(F.min(F.struct((-F.col(score)).alias("s"), F.col(tie), *rest)).alias("b"))
    return top.select(model, (-F.col("b.s")).alias(score), *[F.col(f"b.{c}").alias(c) for c in [tie, *rest]])


def concat_by_model(results: dict[str, DataFrame], name: str = "model") -> DataFrame:
    """Union of per-model results, each row keyed by its model."""
    parts = [df.withColumn(name, F.lit(k)) for k, df in results.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def cv_table(scores: DataFrame, folds: Sequence[int], model: str = "model", fold: str = "fold",
             score: str = "score") -> DataFrame:
    """One row per model: a column per fold, then their mean and sample deviation."""
    wide = scores.groupBy(model).pivot(fold, list(folds)).agg(F.max(score))
    named = wide.select(model, *[F.col(str(f)).alias(f"fold_{f}") for f in folds])
    spread = scores.groupBy(model).agg(F.avg(score).alias("mean_cv"), F.stddev_samp(score).alias("std_cv"))
    return named.join(spread, model)


def cv_summary(scored: DataFrame, metric, model: str = "model", fold: str = "fold") -> DataFrame:
    """A metric per model and fold, and over all out-of-fold rows (fold NULL), from one rollup."""
    both = scored.rollup(model, fold).agg(metric.alias("score"), F.grouping(model).alias("__all"))
    return both.where("__all = 0").drop("__all")


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), pages)
