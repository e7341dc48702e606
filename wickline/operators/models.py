"""Training, tuning and cross-validation on pyspark.ml.

A model is always a whole chain, preprocessing included, so what is stored is what was fitted. Fits that
share their training rows share one persisted frame and run a few at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickline import schemas
from wickline.functions.hashing import hashed_uniform
from wickline.functions.pvalues import student_p
from wickline.operators.linear_block import bootstrap_weights, fit_linear_block, predict_linear_block
from wickline.operators.features import numeric_stage, preprocess_chain
from wickline.operators.metrics import overall_metrics, ranking_metrics
from wickline.operators.neighbours import knn_classify
from wickline.operators.resampling import SEED, class_sizes, poisson_bootstrap
from wickline.operators.running import ordered_sums
from wickline.small import broadcast_table_if_small

# Default training settings.
ALPHA, ITERATIONS, EPOCHS, TRIALS = 1e-4, 10, 5, 3
TRIAL_SPACE = {"alpha": ("log", 1e-4, 2e-4), "power_t": ("uniform", 0.1, 0.5)}


@contextmanager
def kept(df: DataFrame):
    """Keep a frame in executor memory, spilling to disk, while a block of fits reads it repeatedly."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def side_by_side(spark: SparkSession, jobs: Sequence[Callable], parallelism: int) -> list:
    """Run independent Spark jobs a few at a time; the work itself stays on the executors."""
    with ThreadPool(max(1, min(parallelism, len(jobs) or 1))) as pool:
        return pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs)


def linear_estimator(alpha: float = ALPHA, iterations: int = ITERATIONS, features: str = "features",
                     label: str = schemas.TARGET, weight: str | None = None) -> LogisticRegression:
    """Log-loss with an L2 penalty of strength alpha on already scaled features."""
    est = LogisticRegression(featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=0.0,
                             standardization=False, maxIter=iterations)
    return est.setWeightCol(weight) if weight else est


def scored(model: Model, df: DataFrame, label: str | None = schemas.TARGET, keys: Sequence[str] = ()) -> DataFrame:
    """Apply a classifier: y, y_pred and p (absent for models without probabilities)."""
    out = model.transform(df)
    columns = [*keys]
    if label:
        columns.append(F.col(label).cast("int").alias("y"))
    columns.append(F.col("prediction").cast("int").alias("y_pred"))
    if "probability" in out.columns:
        columns.append(vector_to_array("probability")[1].alias("p"))
    return out.select(*columns)


def train_linear(train: DataFrame, val: DataFrame | None = None, alpha: float = ALPHA, iterations: int = ITERATIONS,
                 epochs: int = EPOCHS, label: str = schemas.TARGET, parallelism: int = 4):
    """Fit on a preprocessed frame; returns the last model and metric rows per epoch.

    Epoch e has had (e + 1) x iterations passes. Both frames are measured in one job over all epochs.
    """
    val = train if val is None else val
    with kept(train) as frame:
        models = side_by_side(train.sparkSession, [
            lambda e=e: linear_estimator(alpha, iterations * (e + 1), label=label).fit(frame) for e in range(epochs)],
            parallelism)
    sets = [scored(m, d, label).withColumns({"step": F.lit(e), "part": F.lit(name)})
            for e, m in enumerate(models) for name, d in (("train", train), ("val", val))]
    history = overall_metrics(reduce(DataFrame.unionByName, sets), ["step", "part"])
    return models[-1], history


def prior_baseline(train: DataFrame, df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Every row gets the class shares of the training rows; the most frequent class is predicted, of equals the first.

    The classes become column names (``p_`` and the class) and so pass through the driver; where there are very many,
    :func:`prior_scores` gives the share of each row's own class instead.
    """
    rows = sorted(class_sizes(train, label).where("label is not null").collect(), key=lambda r: r["label"])
    total = sum(r["n"] for r in rows)
    top = min(rows, key=lambda r: (-r["n"], r["label"]))["label"] if rows else None
    shares = [F.lit(r["n"] / total).alias(f"p_{r['label']}") for r in rows]
    return df.select(*keys, F.col(label).alias("y"), F.lit(top).cast(df.schema[label].dataType).alias("y_pred"), *shares)


def prior_scores(train: DataFrame, df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """The prior baseline for any number of classes: the predicted class and the share of each row's own class, ``p_true``."""
    sizes = class_sizes(train, label).where("label is not null")
    one = sizes.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
    top = sizes.where(F.col("n") == F.lit(one["most"])).agg(F.min("label")).first()[0]
    shares = sizes.select(F.col("label").alias("__label"), (F.col("n") / F.lit(one["total"])).alias("__share"))
    return df.join(broadcast_table_if_small(shares), F.col(label) == F.col("__label"), "left").select(
        *keys, F.col(label).alias("y"), F.lit(top).cast(df.schema[label].dataType).alias("y_pred"),
        F.coalesce("__share", F.lit(0.0)).alias("p_true"))


def stratified_baseline(train: DataFrame, df: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """Every row draws a class at random with the training shares; the draw is a hash of the key.

    Each class owns a stretch of 0 to 1. Both sides meet in equal cells of it, so any number of classes costs one join.
    """
    sizes = class_sizes(train, label).where("label is not null")
    one = sizes.agg(F.sum("n").alias("total"), F.count("*").alias("classes")).first()
    total, cells = one["total"] or 1, max(one["classes"], 1)
    cell = lambda u: F.least(F.floor(u * cells), F.lit(cells - 1)).cast("int")
    upto = ordered_sums(sizes, [F.col("label")], {"upto": "n"})
    stretches = upto.select(
        F.col("label").alias("__label"), ((F.col("upto") - F.col("n")) / F.lit(total)).alias("__low"),
        F.when(F.col("upto") < total, F.col("upto") / F.lit(total)).otherwise(F.lit(math.inf)).alias("__high"))
    dealt = stretches.withColumn("__cell", F.explode(F.sequence(cell(F.col("__low")), cell(F.least("__high", F.lit(1.0))))))
    drawn = df.withColumn("__u", hashed_uniform(seed, F.col(key))).withColumn("__cell", cell(F.col("__u")))
    own = (F.col("a.__cell") == F.col("b.__cell")) & (F.col("__u") >= F.col("__low")) & (F.col("__u") < F.col("__high"))
    return drawn.alias("a").join(broadcast_table_if_small(dealt).alias("b"), own, "left").select(
        f"a.{key}", F.col(f"a.{label}").alias("y"), F.col("__label").alias("y_pred"))


# The fitted candidates of the spot check, which adds the stratified draw and the neighbours.
def model_zoo(label: str = schemas.TARGET, seed: int = SEED) -> dict[str, Estimator]:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "logistic": LogisticRegression(maxIter=50, **common),
        "linear_svc": LinearSVC(maxIter=20, **common),
        "tree": DecisionTreeClassifier(seed=seed, **common),
        "forest": RandomForestClassifier(numTrees=10, seed=seed, **common),
    }


def train_on_fold(df: DataFrame, fold: int, models: dict[str, Estimator], label: str, keys: Sequence[str],
                  numeric: Sequence[str], categorical: Sequence[str] = (), fold_column: str = "fold") -> DataFrame:
    """Out-of-fold predictions of one fold; preprocessing is fitted inside the fold."""
    train, held = df.where(F.col(fold_column) != fold), df.where(F.col(fold_column) == fold)
    chain = preprocess_chain(train, numeric, categorical)
    parts = []
    with kept(chain.transform(train).select("features", label)) as frame:
        for name, est in models.items():
            out = scored(est.fit(frame), chain.transform(held), label, [*keys, fold_column])
            if "p" not in out.columns:
                out = out.withColumn("p", F.lit(None).cast("double"))
            parts.append(out.withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def oof_predictions(df: DataFrame, folds: Sequence[int], models: dict[str, Estimator], label: str = schemas.TARGET,
                    keys: Sequence[str] = tuple(schemas.KEY), numeric: Sequence[str] = tuple(schemas.FEATURES),
                    categorical: Sequence[str] = (), parallelism: int = 4) -> DataFrame:
    """Every row predicted by models that have not seen its fold."""
    parts = side_by_side(df.sparkSession, [lambda k=k: train_on_fold(df, k, models, label, keys, numeric, categorical)
                          for k in folds], parallelism)
    return reduce(DataFrame.unionByName, parts)


def spot_check(df: DataFrame, folds: Sequence[int], label: str = schemas.TARGET, key: str = "key",
               numeric: Sequence[str] = tuple(schemas.FEATURES), k: int = 8, fold_column: str = "fold") -> DataFrame:
    """Out-of-fold predictions (model, fold, key, y, y_pred) of all candidates: the fitted ones, the stratified draw and
    the ``k`` nearest neighbours in scaled features. Keys are whole numbers."""
    columns, scaled = ["model", fold_column, key, "y", "y_pred"], [f"{c}_scaled" for c in numeric]
    parts = [oof_predictions(df, folds, model_zoo(label), label, [key], numeric).select(*columns)]
    for fold in folds:
        train, held = df.where(F.col(fold_column) != fold), df.where(F.col(fold_column) == fold)
        stage = numeric_stage(train, numeric)
        near = knn_classify(stage.transform(held), stage.transform(train), key, scaled, label, k)
        near = held.select(key, F.col(label).alias("y")).join(near, key, "left")
        for name, found in (("stratified", stratified_baseline(train, held, label, key)), ("neighbours", near)):
            parts.append(found.select(F.lit(name).alias("model"), F.lit(fold).alias(fold_column), key,
                                      F.col("y").cast("int").alias("y"), F.col("y_pred").cast("int").alias("y_pred")))
    return reduce(DataFrame.unionByName, parts)


def cross_validation(df: DataFrame, folds: Sequence[int], models: dict[str, Estimator], metric: Column,
                     **options) -> DataFrame:
    """Score per model and fold."""
    return oof_predictions(df, folds, models, **options).groupBy("model", "fold").agg(metric.alias("score"))


def sample_trials(studies: DataFrame, study: str, n_trials: int = TRIALS, space: dict = TRIAL_SPACE,
                  seed: int = SEED) -> DataFrame:
    """Seeded parameter draws: one row per study and trial, a column per parameter.

    ``log`` ranges are sampled uniformly in the logarithm.
    """
    rows = studies.select(study, F.explode(F.sequence(F.lit(0), F.lit(n_trials - 1))).alias("trial"))

    def draw(name: str, kind: str, low: float, high: float) -> Column:
        u = hashed_uniform(seed, F.lit(name), F.col(study), F.col("trial"))
        if kind == "log":
            return F.exp(F.lit(math.log(low)) + u * F.lit(math.log(high) - math.log(low))).alias(name)
        return (F.lit(low) + u * F.lit(high - low)).alias(name)

    return rows.select(study, "trial", *[draw(n, *spec) for n, spec in space.items()])


def tune(train: DataFrame, val: DataFrame, n_trials: int = TRIALS, monitor: str = "accuracy", seed: int = SEED,
         label: str = schemas.TARGET, study: str = "linear", parallelism: int = 4):
    """Random search over the trial space on a fixed validation part.

    Returns the trials table (number, parameters as a map, the nine metrics, best first by loss) and the
    parameters of the trial with the greatest monitored metric.
    """
    spark = train.sparkSession
    studies = spark.createDataFrame([(study,)], "study string")
    trials = sample_trials(studies, "study", n_trials, seed=seed).orderBy("trial").collect()
    base = linear_estimator(label=label, iterations=ITERATIONS * EPOCHS)
    with kept(train) as frame:
        models = side_by_side(
            spark, [lambda t=t: base.copy({base.regParam: t["alpha"]}).fit(frame) for t in trials], parallelism)
    parts = [scored(m, val, label).withColumn("trial", F.lit(t["trial"])) for t, m in zip(trials, models)]
    measured = overall_metrics(reduce(DataFrame.unionByName, parts), ["trial"], "val")
    params = spark.createDataFrame([(t["trial"], {"alpha": t["alpha"], "power_t": t["power_t"]}) for t in trials],
                                   "trial int, params map<string,double>")
    table = trials_table(params, measured)
    best = table.agg(F.max_by("params", F.struct(F.col(f"val_{monitor}"), -F.col("trial")))).first()[0]
    return table, best


def trials_table(params: DataFrame, measured: DataFrame, loss: str = "val_loss") -> DataFrame:
    """One row per trial with typed parameters and metrics, ranked by loss."""
    w = Window.orderBy(loss, "trial")
    return params.join(measured, "trial").withColumn("loss_rank", F.row_number().over(w))


def retrain(train: DataFrame, params: dict[str, float], label: str = schemas.TARGET) -> Model:
    """Fit on all training rows with the best parameters."""
    return linear_estimator(params["alpha"], ITERATIONS * EPOCHS, label=label).fit(train)


def default_grids(label: str = schemas.TARGET) -> dict[str, tuple[Estimator, list[dict]]]:
    """Candidate models with the settings to try."""
    zoo = model_zoo(label)
    logistic, tree, forest = zoo["logistic"], zoo["tree"], zoo["forest"]
    return {
        "logistic": (logistic, ParamGridBuilder().addGrid(logistic.regParam, [1e-4, 1e-2])
                     .addGrid(logistic.elasticNetParam, [0.0, 1.0]).build()),
        "tree": (tree, ParamGridBuilder().addGrid(tree.maxDepth, [3, 5]).build()),
        "forest": (forest, ParamGridBuilder().addGrid(forest.maxDepth, [3, 5]).build()),
    }


def _setting_text(setting: dict) -> str:
    return ",".join(f"{p.name}={v}" for p, v in sorted(setting.items(), key=lambda e: e[0].name))


def grid_search(df: DataFrame, folds: Sequence[int], label: str = schemas.TARGET, fold_column: str = "fold",
                numeric: Sequence[str] = tuple(schemas.FEATURES), categorical: Sequence[str] = (),
                parallelism: int = 4, grids: dict[str, tuple[Estimator, list[dict]]] | None = None):
    """Cross-validated search per model with refit; returns the result rows and the best whole chains.

    ``grids`` maps a name to an estimator and its parameter maps. Preprocessing is fitted inside every fold,
    once for all settings; the score is the exact area under the ROC curve of the held fold, measured for all
    settings in one job.
    """
    spark, grids = df.sparkSession, grids or default_grids(label)
    tries = [(name, n, est, setting) for name, (est, grid) in grids.items() for n, setting in enumerate(grid)]
    rows, keys = [], "model string, setting int, fold int, score double"
    for fold in folds:
        train, held = df.where(F.col(fold_column) != fold), df.where(F.col(fold_column) == fold)
        chain = preprocess_chain(train, numeric, categorical)
        with kept(chain.transform(train).select("features", label)) as frame:
            fitted = side_by_side(spark, [lambda t=t: t[2].fit(frame, t[3]) for t in tries], parallelism)
        ready = chain.transform(held).select("features", label)
        parts = [scored(m, ready, label).withColumns({"model": F.lit(t[0]), "setting": F.lit(t[1])})
                 for t, m in zip(tries, fitted)]
        areas = ranking_metrics(reduce(DataFrame.unionByName, parts), ["model", "setting"])
        rows += [(r["model"], r["setting"], fold, r["roc_auc"]) for r in areas.collect()]  # one row per setting
    texts = spark.createDataFrame([(name, n, _setting_text(setting)) for name, n, _, setting in tries],
                                  "model string, setting int, param string")
    results = spark.createDataFrame(rows, keys).groupBy("model", "setting").agg(
        F.avg("score").alias("mean_test_score"), F.stddev_pop("score").alias("std_test_score"))
    tops = {r["model"]: r["setting"] for r in results.groupBy("model").agg(
        F.max_by("setting", F.struct("mean_test_score", -F.col("setting"))).alias("setting")).collect()}
    chain = preprocess_chain(df, numeric, categorical)
    with kept(chain.transform(df).select("features", label)) as frame:
        best = {name: full_chain(chain, grids[name][0].fit(frame, grids[name][1][n])) for name, n in tops.items()}
    return results.join(texts, ["model", "setting"]).drop("setting"), best


def cv_difference(scores: DataFrame, first: str, second: str) -> DataFrame:
    """Paired t statistic of two models over the same folds."""
    pair = scores.groupBy("fold").agg(F.max(F.when(F.col("model") == first, F.col("score"))).alias("a"),
                                      F.max(F.when(F.col("model") == second, F.col("score"))).alias("b"))
    return paired_t(pair, "a", "b")


def paired_t(pairs: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """t of the mean difference with sample deviation, its degrees of freedom and its two-sided ``p``."""
    diff = F.col(a) - F.col(b)
    one = pairs.groupBy(*by).agg(F.avg(diff).alias("mean_diff"), F.stddev_samp(diff).alias("sd"),
                                 F.count(diff).alias("k"))
    measured = one.select(*by, "mean_diff", F.try_divide(F.col("mean_diff") * F.sqrt("k"), F.col("sd")).alias("t_stat"),
                          (F.col("k") - 1).alias("df"))
    return measured.withColumn("p", student_p("t_stat", "df"))


def bias_variance_fit(train: DataFrame, test: DataFrame, key: str, rounds: int = 200, seed: int = 42,
                      estimator: Estimator | None = None, label: str = schemas.TARGET,
                      parallelism: int = 4, loss: str = "0-1_loss", alpha: float = ALPHA) -> DataFrame:
    """(round, test_id, pred): each round fits bootstrap weights of the training rows, then predicts the test rows.

    Without an ``estimator`` all rounds are one block of linear models, fitted and applied in the same scans; with the loss
    ``mse`` they are fitted to squared errors and predict numbers.
    """
    if estimator is None:
        squared = loss == "mse"
        block = fit_linear_block(train, [alpha] * rounds, label=label, weights=bootstrap_weights(rounds, F.col(key), seed), squared=squared)
        values = predict_linear_block(test, block, [key], squared=squared).select(
            F.posexplode("p").alias("round", "p"), F.col(key).alias("test_id"))
        return values.select("round", "test_id", (F.col("p") if squared else (F.col("p") >= 0.5).cast("int")).alias("pred"))
    est = estimator
    with kept(train.select(key, "features", label)) as frame:
        models = side_by_side(train.sparkSession, [
            lambda r=r: est.copy({est.weightCol: "weight"}).fit(
                poisson_bootstrap(frame, key, r, seed).where("weight > 0")) for r in range(rounds)], parallelism)
    return predict_side_by_side(models, test, F.col(key).alias("test_id"), "round").withColumnRenamed("y_pred", "pred")


def predict_side_by_side(models: Sequence[Model], df: DataFrame, key: Column, number: str) -> DataFrame:
    """Predictions of many classifiers on the same rows, one row per model, from a single scan."""
    wide = df.select(key, "features")
    name, columns = wide.columns[0], []
    for n, model in enumerate(models):
        model = model.copy().setRawPredictionCol("").setPredictionCol(f"__pred{n}")
        if model.hasParam("probabilityCol"):
            model = model.setProbabilityCol("")
        wide = model.transform(wide)
        columns.append(F.struct(F.lit(n).alias(number), F.col(f"__pred{n}").cast("int").alias("y_pred")))
    return wide.select(name, F.inline(F.array(*columns))).select(number, name, "y_pred")


def full_chain(chain: PipelineModel, classifier: Model) -> PipelineModel:
    """Preprocessing and classifier as one storable model."""
    return PipelineModel(stages=[*chain.stages, classifier])
