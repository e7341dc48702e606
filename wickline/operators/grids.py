"""The whole grid of settings by cross-validation, with the settings that can share a fit sharing it.

* All penalties of the logistic model are one block of weights (``linear_block``), fitted in the same passes.
* A tree's splits do not depend on how deep it may grow, so one tree of the greatest depth for each criterion and leaf size
  serves all smaller depths: its nodes are read off at each depth, with equal leaves merged as the library does.
* Forests draw their features anew for each depth and are fitted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline import schemas
from wickline.operators.features import preprocess_chain
from wickline.operators.linear_block import fit_linear_block, plain_features, predict_linear_block
from wickline.operators.metrics import ranking_metrics
from wickline.operators.models import full_chain, kept, scored, side_by_side
from wickline.operators.resampling import SEED
from wickline.session import fresh_path
from wickline.sources.paths import remove

# The settings of the search. No limit on the depth is the library's greatest.
PENALTIES = ("l1", "l2")
STRENGTHS = tuple(10 ** (-4 + 8 * k / 9) for k in range(10))
DEPTHS, LEAVES, CRITERIA = (2, 3, 5, 10, 20), (5, 10, 20, 50, 100), ("gini", "entropy")
FOREST_DEPTHS, FOREST_TREES, DEEPEST = (3, 6, None), 10, 30


@dataclass(frozen=True)
class Settings:
    """What is tried; the defaults are all 73 settings."""

    penalties: Sequence[str] = PENALTIES
    strengths: Sequence[float] = STRENGTHS
    depths: Sequence[int] = DEPTHS
    leaves: Sequence[int] = LEAVES
    criteria: Sequence[str] = CRITERIA
    forest_depths: Sequence[int | None] = FOREST_DEPTHS

    def logistic(self) -> list[tuple[str, float]]:
        return [(p, c) for p in self.penalties for c in self.strengths]

    def trees(self) -> list[tuple[str, int]]:
        return [(c, n) for c in self.criteria for n in self.leaves]

    def texts(self) -> dict[str, list[str]]:
        """The settings of each model in the order of their numbers."""
        return {"logistic": [f"C={c:.6g},penalty={p}" for p, c in self.logistic()],
                "tree": [f"criterion={c},max_depth={d},min_samples_leaf={n}" for c, n in self.trees() for d in self.depths],
                "forest": [f"max_depth={d}" for d in self.forest_depths]}


@dataclass
class Levels:
    """A tree as arrays, node by node: where it sends a row, and its probability if it ends there."""

    feature: np.ndarray
    threshold: np.ndarray
    to_left: np.ndarray  # for features with categories: whether each goes left
    children: np.ndarray
    p: np.ndarray
    prediction: np.ndarray

    @classmethod
    def of(cls, model: Model, spark: SparkSession) -> "Levels":
        """Read from the model's stored nodes; their number is bounded by the tree, not by the rows."""
        path = fresh_path(spark, "tree")
        model.write().save(path)
        rows = sorted(spark.read.parquet(f"{path}/data").collect(), key=lambda r: r["id"])
        remove(spark, path)
        n = len(rows)
        most = max([1, *(r["split"]["numCategories"] for r in rows)])
        tree = cls(np.full(n, -1), np.zeros(n), np.zeros((n, most), dtype=bool), np.full((n, 2), -1), np.zeros(n), np.zeros(n))
        for i, r in enumerate(rows):
            stats = r["impurityStats"]
            tree.p[i], tree.prediction[i] = (stats[1] if len(stats) > 1 else 0.0) / (sum(stats) or 1.0), r["prediction"]
            if r["leftChild"] >= 0:
                tree.children[i], tree.feature[i] = (r["leftChild"], r["rightChild"]), r["split"]["featureIndex"]
                if r["split"]["numCategories"] < 0:
                    tree.threshold[i] = r["split"]["leftCategoriesOrThreshold"][0]
                else:
                    tree.threshold[i] = np.nan
                    tree.to_left[i, [int(c) for c in r["split"]["leftCategoriesOrThreshold"]]] = True
        return tree

    def at(self, depth: int) -> "Levels":
        """The tree that a limit of ``depth`` would have grown."""
        children = self.children.copy()

        def cut(node: int, left: int) -> bool:
            """Whether the node ends up a leaf."""
            if children[node, 0] < 0 or left == 0:
                children[node] = -1
                return True
            a, b = children[node]
            ends = cut(a, left - 1), cut(b, left - 1)
            if all(ends) and self.prediction[a] == self.prediction[b]:
                children[node] = -1
                return True
            return False

        cut(0, depth)
        return Levels(self.feature, self.threshold, self.to_left, children, self.p, self.prediction)

    def score(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        while (open_rows := np.flatnonzero(self.children[node, 0] >= 0)).size:
            at = node[open_rows]
            value, limit = x[open_rows, self.feature[at]], self.threshold[at]
            by_category = np.isnan(limit)
            left = value <= limit
            left[by_category] = self.to_left[at[by_category], value[by_category].astype(np.int64)]
            node[open_rows] = np.where(left, self.children[at, 0], self.children[at, 1])
        return self.p[node]


def _score(batches: Iterator[pa.RecordBatch], trees: list[Levels]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        p = np.stack([t.score(x) for t in trees], axis=1) if batch.num_rows else np.empty((0, len(trees)))
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(list(p), pa.list_(pa.float64()))], names=["y", "p"])


def score_trees(df: DataFrame, trees: list[Levels], label: str, features: str = "features") -> DataFrame:
    """y and ``p``, an array with every tree's probability, from one scan."""
    rows = df.select(F.col(label).cast("int").alias("y"), plain_features(df, features).alias("x"))
    return rows.mapInArrow(partial(_score, trees=trees), "y int, p array<double>")


def _fold_scores(train: DataFrame, held: DataFrame, tried: Settings, label: str, parallelism: int, seed: int) -> DataFrame:
    """model, setting and roc_auc on ``held`` of every setting, all measured in one job."""
    common = {"featuresCol": "features", "labelCol": label}
    n, parts = train.count(), []
    if tried.logistic():
        reg = [1.0 / (n * c) for _, c in tried.logistic()]
        lasso = [p == "l1" for p, _ in tried.logistic()]
        c = fit_linear_block(train, [0.0 if a else r for a, r in zip(lasso, reg)], [r if a else 0.0 for a, r in zip(lasso, reg)], label=label)
        block = predict_linear_block(held.withColumn("y", F.col(label).cast("int")), c, ["y"])
        parts.append(("logistic", block.select("y", F.posexplode("p").alias("setting", "p"))))
    deep = [lambda c=c, leaf=leaf: Levels.of(DecisionTreeClassifier(
        maxDepth=max(tried.depths), minInstancesPerNode=leaf, impurity=c, seed=seed, **common).fit(train), train.sparkSession)
            for c, leaf in tried.trees()]
    grown = side_by_side(train.sparkSession, deep, parallelism) if tried.depths else []
    if grown:
        cut = [tree.at(d) for tree in grown for d in tried.depths]
        parts.append(("tree", score_trees(held, cut, label).select("y", F.posexplode("p").alias("setting", "p"))))
    forests = side_by_side(train.sparkSession, [lambda d=d: RandomForestClassifier(
        numTrees=FOREST_TREES, maxDepth=DEEPEST if d is None else d, seed=seed, **common).fit(train) for d in tried.forest_depths], parallelism)
    parts += [("forest", scored(m, held, label).select("y", F.lit(k).alias("setting"), "p")) for k, m in enumerate(forests)]
    return ranking_metrics(reduce(DataFrame.unionByName, [df.withColumn("model", F.lit(name)) for name, df in parts]), ["model", "setting"])


def search_grid(df: DataFrame, folds: Sequence[int], tried: Settings = Settings(), label: str = schemas.TARGET, fold_column: str = "fold",
                numeric: Sequence[str] = tuple(schemas.FEATURES), categorical: Sequence[str] = (), parallelism: int = 8, seed: int = SEED):
    """(model, param, mean_test_score, std_test_score) of every setting, and the whole chains of the best ones.

    The score is the exact area under the ROC curve of the held fold; preprocessing is fitted inside every fold. The best
    setting of each model (of equals the first) is fitted again on all rows.
    """
    spark, rows, texts = df.sparkSession, [], tried.texts()
    for fold in folds:
        chain = preprocess_chain(df.where(F.col(fold_column) != fold), numeric, categorical)
        with kept(chain.transform(df).select("features", label, fold_column)) as ready:
            areas = _fold_scores(ready.where(F.col(fold_column) != fold), ready.where(F.col(fold_column) == fold), tried, label, parallelism, seed)
            rows += [(r["model"], r["setting"], texts[r["model"]][r["setting"]], r["roc_auc"]) for r in areas.collect()]  # one a setting
    results = spark.createDataFrame(rows, "model string, setting int, param string, score double").groupBy("model", "setting", "param").agg(
        F.avg("score").alias("mean_test_score"), F.stddev_pop("score").alias("std_test_score"))
    tops = {r["model"]: r["setting"] for r in results.groupBy("model").agg(
        F.max_by("setting", F.struct("mean_test_score", -F.col("setting"))).alias("setting")).collect()}
    chain, best, common = preprocess_chain(df, numeric, categorical), {}, {"featuresCol": "features", "labelCol": label}
    with kept(chain.transform(df).select("features", label)) as frame:
        n = frame.count()
        for name, k in tops.items():
            if name == "logistic":
                penalty, c = tried.logistic()[k]
                est = LogisticRegression(regParam=1.0 / (n * c), elasticNetParam=float(penalty == "l1"), standardization=False, maxIter=1000, **common)
            elif name == "tree":
                criterion, leaf = tried.trees()[k // len(tried.depths)]
                est = DecisionTreeClassifier(maxDepth=tried.depths[k % len(tried.depths)], minInstancesPerNode=leaf, impurity=criterion, seed=seed, **common)
            else:
                depth = tried.forest_depths[k]
                est = RandomForestClassifier(numTrees=FOREST_TREES, maxDepth=DEEPEST if depth is None else depth, seed=seed, **common)
            best[name] = full_chain(chain, est.fit(frame))
    return results.drop("setting"), best
