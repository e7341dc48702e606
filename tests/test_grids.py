"""The whole grid: trees cut at a depth against trees grown to it, and the number and scores of all settings."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import functions as F

from wickline.operators import biasvariance, grids, models, ranking, resampling


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    a, b, c = rng.standard_normal(600), rng.standard_normal(600), rng.integers(0, 3, 600)
    y = ((a + 0.5 * b * (c == 1) + rng.standard_normal(600) * 0.7) > 0).astype(int)
    df = spark.createDataFrame([(f"k{i}", float(a[i]), float(b[i]), int(c[i]), int(y[i])) for i in range(600)], "key string, a double, b double, c int, y int")
    return df.repartition(4).persist()


def test_depths_of_one_tree_equal_trees_of_these_depths(spark, rows):
    hot = OneHotEncoder(inputCol="c", outputCol="hot").fit(rows).transform(rows)
    df = VectorAssembler(inputCols=["a", "b", "hot"], outputCol="features").transform(hot).persist()
    for criterion, leaf in (("gini", 5), ("entropy", 20)):
        tree = lambda depth: DecisionTreeClassifier(
            labelCol="y", maxDepth=depth, minInstancesPerNode=leaf, impurity=criterion, seed=1).fit(df)
        deep = grids.Levels.of(tree(20), spark)
        for depth in (1, 2, 3, 5, 10, 20):
            want = [(r.y, round(r.p, 9)) for r in models.scored(tree(depth), df, "y").collect()]
            got = [(r.y, round(r.p[0], 9)) for r in grids.score_trees(df, [deep.at(depth)], "y").collect()]
            assert got == want
    assert grids.score_trees(df.limit(0), [deep], "y").count() == 0


def test_all_settings_are_scored(rows):
    whole = grids.Settings()
    assert [len(whole.texts()[m]) for m in ("logistic", "tree", "forest")] == [20, 50, 3]
    folded = resampling.stratified_kfold(rows, "key", "y", 2)
    few = grids.Settings(strengths=(1e-3, 1.0), depths=(2, 5), leaves=(10,), forest_depths=(3,))
    results, best = grids.search_grid(folded, [1, 2], few, "y", numeric=["a", "b"], categorical=["c"])
    table = ranking.rank_grid(results).collect()
    assert len(table) == 4 + 4 + 1 and set(best) == {"logistic", "tree", "forest"}
    scores = {r.param: r.mean_test_score for r in table}
    assert all(0.5 <= s <= 1 for s in scores.values()) and scores["C=1,penalty=l2"] > 0.8
    assert best["tree"].transform(rows).count() == 600


def test_bias_and_variance_by_hand(spark):
    votes = spark.createDataFrame([(0, 1, 1), (1, 1, 0), (2, 1, 1), (0, 2, 2), (1, 2, 1), (2, 2, 0), (3, 3, 5)], "round int, test_id int, pred int")
    truth = spark.createDataFrame([(1, 1), (2, 0), (3, 4)], "test_id int, y int")
    r = biasvariance.bias_variance_summary(votes, truth).first()
    # Main votes 1, 0 (the lowest of three), 5; votes unlike the main one 1/3, 2/3, 0.
    assert abs(r.expected_loss - (1 / 3 + 2 / 3 + 1) / 3) < 1e-12 and abs(r.bias - 1 / 3) < 1e-12 and abs(r.variance - 1 / 3) < 1e-12


def test_rounds_of_both_losses(spark, rows):
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    train, test = df.where(F.col("b") < 0.5), df.where(F.col("b") >= 0.5)
    for loss, kind in (("0-1_loss", "int"), ("mse", "double")):
        votes = models.bias_variance_fit(train, test, "key", 200, label="y", loss=loss)
        assert votes.dtypes[2] == ("pred", kind) and votes.count() == 200 * test.count()
        summary = biasvariance.bias_variance_summary(votes, test.select(F.col("key").alias("test_id"), "y"), loss).first()
        assert 0 < summary.variance < summary.expected_loss < 0.5
