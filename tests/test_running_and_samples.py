"""Bucketed ranks, totals and quantiles against plain ones; splits and folds."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wickline.functions.hashing import shuffle_key
from wickline.operators import resampling, running


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one value."""
    rng = np.random.default_rng(1)
    xs = [float(x) for x in rng.normal(size=2000)] + [0.25] * 1000
    return spark.createDataFrame([(i, i % 2, x) for i, x in enumerate(xs)], "id bigint, g int, x double")


def test_cut_points_split_evenly(values):
    cuts = running.cut_points(values, "x", 300)
    sizes = [r["count"] for r in running.with_bucket(values, "x", cuts, "b").groupBy("b").count().collect()]
    assert len(cuts) >= 6 and max(sizes) <= 1500
    assert running.cut_points(values, "x") == []


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_in_buckets(values, descending):
    counts = values.groupBy("g", "x").agg(F.count("*").alias("n"))
    plain = running.running_totals(counts, "x", {"t": "n"}, ["g"], descending=descending)
    cuts = running.cut_points(values, "x", 100)
    split = running.running_totals(counts, "x", {"t": "n"}, ["g"], cuts, descending)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("descending", [False, True])
def test_next_values_equal_in_buckets(values, descending):
    counts = values.groupBy("x").agg(F.count("*").alias("n"))
    plain = running.next_values(counts, "x", {"nx": "x", "nn": "n"}, descending=descending)
    split = running.next_values(counts, "x", {"nx": "x", "nn": "n"}, cuts=running.cut_points(values, "x", 100),
                                descending=descending)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("per_bucket", [50, 1_000_000])
def test_exact_quantiles(values, per_bucket):
    qs = [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]
    xs = np.array([r["x"] for r in values.collect()])
    both = values.withColumn("y", F.col("x") * 1000).withColumn("z", F.lit(None).cast("double"))
    rows = {r["column"]: r for r in running.exact_quantiles(both, ["x", "y", "z"], qs, per_bucket).collect()}
    assert set(rows) == {"x", "y"} and rows["x"]["n"] == 3000
    for i, q in enumerate(qs):
        assert rows["x"][f"q{i}"] == pytest.approx(np.quantile(xs, q), abs=1e-12)
        assert rows["y"][f"q{i}"] == pytest.approx(np.quantile(xs, q) * 1000, abs=1e-9)


def test_hash_rank_is_the_plain_rank(values):
    ranked = running.hash_ranked(values, shuffle_key(7, F.col("id")), ["g"], digits=2)
    rows = ranked.withColumn("h", shuffle_key(7, F.col("id"))).collect()
    for g in (0, 1):
        own = sorted((r["h"], r["rank"]) for r in rows if r["g"] == g)
        assert [k for _, k in own] == list(range(1, len(own) + 1))


def test_split_sizes_follow_the_classes(spark):
    """3000 rows give 2100, 450 and 450, and each class keeps its share to one row."""
    df = spark.range(3000).withColumn("y", (F.col("id") % 17 == 0).cast("int"))
    out = resampling.stratified_split(df, "id", "y")
    sizes = {(r["split"], r["y"]): r["count"] for r in out.groupBy("split", "y").count().collect()}
    n1 = df.where("y = 1").count()
    for name, share in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
        assert sizes[(name, 0)] + sizes[(name, 1)] == round(3000 * share)
        assert abs(sizes[(name, 1)] - n1 * share) <= 1
    assert out.select("id").distinct().count() == 3000
    again = resampling.stratified_split(df.repartition(7), "id", "y")
    assert out.exceptAll(again).isEmpty()
    other = resampling.stratified_split(df, "id", "y", seed=1)
    assert not out.exceptAll(other).isEmpty()


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([(i, "abc"[min(i, 2)]) for i in range(10)], "id bigint, y string")
    out = resampling.stratified_split(df, "id", "y")
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 7, "val": 1, "test": 2}


def test_split_summary_text(spark):
    df = resampling.stratified_split(spark.range(3000).withColumn("y", F.col("id") % 2), "id", "y")
    rows = {r["split"]: (r["size"], r["percentage"]) for r in resampling.split_summary(df).collect()}
    assert rows == {"train": (2100, "70.00%"), "val": (450, "15.00%"), "test": (450, "15.00%")}


def test_folds_are_even_per_class(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 5 == 0).cast("int"))
    sizes = resampling.stratified_kfold(df, "id", "y", 10).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in sizes if r["y"] == y]
        assert len(n) == 10 and max(n) - min(n) <= 1


def test_group_folds_keep_groups_and_shares(spark):
    df = spark.range(6000).selectExpr("id", "id % 150 as g", "(hash(id) % 5 = 0) as hit")
    out = resampling.group_kfold(df, "g", F.col("hit"), 6)
    assert out.count() == 6000
    assert out.groupBy("g").agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()
    shares = [r["s"] for r in out.groupBy("fold").agg(F.avg(F.col("hit").cast("int")).alias("s")).collect()]
    assert len(shares) == 6 and max(shares) - min(shares) < 0.03


def test_batches(spark):
    out = resampling.shuffle_batches(spark.range(1000), "id", 64)
    sizes = [r["count"] for r in out.groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [64] * 15 + [40]
    assert resampling.shuffle_batches(spark.range(10), "id", None).select("batch").distinct().count() == 1


def test_bootstrap_draws_n_of_n(spark):
    out = resampling.bootstrap_sample(spark.range(500), "id", 4)
    rows = {r["round"]: (r["n"], r["k"]) for r in out.groupBy("round").agg(
        F.sum("draws").alias("n"), F.count("*").alias("k")).collect()}
    assert all(n == 500 and 270 < k < 360 for n, k in rows.values()) and len(rows) == 4


def test_bootstrap_tasks_grow_with_the_draws(spark, monkeypatch):
    """A task counts a bounded number of draws; they are those of the hash."""
    monkeypatch.setattr(resampling, "DRAWS_PER_TASK", 100, raising=False)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = resampling.bootstrap_sample(spark.range(500), "id", 4).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    got, tasks = {}, {}
    for r in rows:
        got[r["round"], r["id"]] = r["draws"]
        tasks[r["task"]] = tasks.get(r["task"], 0) + r["draws"]
    assert len(tasks) >= 15 and max(tasks.values()) <= 250
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    order = sorted(range(500), key=lambda i: f"{digest(f'42:{i}')}:{i}")
    want = Counter((k, order[int(digest(f"42:{k}:{i}")[:15], 16) % 500]) for k in range(4) for i in range(500))
    assert got == want


def test_poisson_weights(spark):
    w = resampling.poisson_bootstrap(spark.range(20000), "id", 3).agg(F.avg("weight"), F.var_pop("weight")).first()
    assert w[0] == pytest.approx(1.0, abs=0.03) and w[1] == pytest.approx(1.0, abs=0.05)


def test_quantiles_of_crowded_values(spark):
    """Fences that cannot shrink below the sort limit still give exact results."""
    df = spark.range(30000).selectExpr("cast(if(id % 3 = 0, 500, id % 1000) as double) as v")
    xs = np.array([r[0] for r in df.collect()])
    qs = [0.1, 0.5, 0.501, 0.9]
    row = running.exact_quantiles(df, ["v"], qs, 3).first()
    assert [row[f"q{i}"] for i in range(4)] == pytest.approx([np.quantile(xs, q) for q in qs])
