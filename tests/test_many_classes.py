"""Any number of classes: the same results as for few, without a limit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wickline.operators import features, metrics, models, resampling, running

CLASSES = 25_000


@pytest.fixture(scope="module")
def many(spark):
    """Four rows of each class, and six without one."""
    label = F.when(F.col("id") >= 4 * CLASSES, None).otherwise(F.format_string("c%05d", F.col("id") % CLASSES))
    return spark.range(4 * CLASSES + 6).select(F.col("id").alias("key"), label.alias("label")).cache()


def test_split_and_folds_share_every_class_out(many):
    split = resampling.stratified_split(many, "key", "label", 0.5, 0.5)
    per = split.groupBy("label", "split").count().groupBy("split").agg(F.min("count").alias("low"), F.max("count").alias("high"), F.count("*").alias("n"))
    assert {r["split"]: (r["low"], r["n"]) for r in per.collect()} == {
        "train": (2, CLASSES + 1), "val": (1, CLASSES + 1), "test": (1, CLASSES + 1)}
    lost = {r["split"]: r["count"] for r in split.where("label is null").groupBy("split").count().collect()}
    assert lost["train"] == 3 and lost["val"] + lost["test"] == 3 and len(lost) == 3
    folds = resampling.stratified_kfold(many, "key", "label", 4).groupBy("label", "fold").count()
    assert {tuple(r) for r in folds.where("label is not null").groupBy("fold", "count").agg(F.count("*")).collect()} == {
        (k, 1, CLASSES) for k in (1, 2, 3, 4)}
    assert sorted(r["count"] for r in folds.where("label is null").collect()) == [1, 1, 2, 2]


def test_codes_of_many_classes(many):
    named = many.where("label is not null")
    coded = features.label_encode(named, "label", "code")
    assert coded.count() == 4 * CLASSES
    assert coded.where("code <> cast(substring(label, 2) as int)").isEmpty()
    with pytest.raises(Exception, match="unknown class NULL"):
        features.label_encode(many, "label", "code", ["c00000"]).where("label is null").collect()


def test_baselines_of_many_classes(many):
    named = many.where("label is not null")
    prior = models.prior_scores(named, many, "label", ["key"])
    assert prior.groupBy("y_pred", F.round(F.col("p_true") * CLASSES, 6).alias("p")).count().orderBy("p").collect() == [
        ("c00000", 0.0, 6), ("c00000", 1.0, 4 * CLASSES)]
    drawn = models.stratified_baseline(named, many, "label", "key")
    assert drawn.count() == 4 * CLASSES + 6 and drawn.where("y_pred is null").isEmpty()
    assert drawn.select("y_pred").distinct().count() > 0.9 * CLASSES


def test_confusion_matrix_of_many_pairs(spark):
    df = spark.range(30_000).select((F.col("id") % 200).alias("y"), (F.col("id") % 191).alias("y_pred"))
    matrix = metrics.confusion_matrix(df)
    assert matrix.agg(F.count("*"), F.sum("n")).first() == (40_000, 30_000)


def test_sums_in_ranges_equal_sums_in_one_task(spark):
    df = spark.range(1000).select(F.format_string("%04d", (F.col("id") * 7) % 1000).alias("name"), (F.col("id") % 5).alias("n"))
    order = [F.col("name").desc()]
    one, many = (running.ordered_sums(df, order, {"upto": "n"}, size) for size in (1000, 100))
    assert sorted(one.collect()) == sorted(many.collect())


def test_borders_in_two_levels(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 50 > 0, F.col("id").cast("double")).alias("x"))
    cuts = running.cut_points(df, "x", 500, first_borders=8)
    assert len(cuts) == 39
    sizes = [r["count"] for r in running.with_bucket(df.where("x is not null"), "x", cuts).groupBy("__bucket").count().collect()]
    # A sketch of p parts errs by a quarter of a part at each border: (1.5 / 8) x 1.5 / 5 of the 19,600 rows at most.
    assert len(sizes) == 40 and max(sizes) <= 1.5 / 8 * 1.5 / 5 * 19_600
