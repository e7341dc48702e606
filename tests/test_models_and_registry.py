"""Preparation, neighbours, training, registry, promotion and scoring."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog.derived import klines_stamped
from wickline.functions.pvalues import normal_p, student_p
from wickline.operators import features, metrics, models, monitoring, neighbours, ranking, registry, resampling, scoring
from wickline.plans.serving import production_model, serve
from wickline.plans.training import REGISTRY_TYPES, TrainingSettings, extract_training_rows, run_training
from wickline.session import settled

LABEL = schemas.TARGET


@pytest.fixture(scope="module")
def rows(spark):
    """A separable two-class table with one category column."""
    rng = np.random.default_rng(8)
    n = 400
    a, b = rng.normal(size=n), rng.normal(5, 3, n)
    y = (a + 0.2 * (b - 5) + rng.normal(scale=0.5, size=n) > 0).astype(int)
    return spark.createDataFrame([(i, float(a[i]), float(b[i]), "uvw"[i % 3], int(y[i])) for i in range(n)],
                                 f"key bigint, a double, b double, c string, {LABEL} int")


@pytest.fixture(scope="module")
def parts(rows):
    split = resampling.stratified_split(rows, "key", LABEL)
    train = split.where("split = 'train'")
    chain = features.preprocess_chain(train, ["a", "b"], ["c"])
    ready = chain.transform(split)
    return {s: ready.where(F.col("split") == s) for s in ("train", "val", "test")}, chain


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "x double, k double")
    out = features.standard_scale(df, df, ["x", "k"]).orderBy("x").collect()
    assert [r["x"] for r in out] == pytest.approx([-1.224744871, 0.0, 1.224744871])
    assert {r["k"] for r in out} == {0.0}
    raw = features.standard_scale(df, df, ["x"], with_mean=False, with_std=False)
    assert [r["x"] for r in raw.orderBy("x").collect()] == [1.0, 2.0, 3.0]


def test_chain_is_fitted_on_train_and_knows_unseen_values(spark, rows):
    train = rows.where("c <> 'w'").withColumn("a", F.when(F.col("key") > 3, F.col("a")))
    chain = features.preprocess_chain(train, ["a", "b"], ["c"])
    wide = chain.transform(train).select(vector_to_array("features").alias("v"))
    mean = wide.agg(*[F.avg(F.col("v")[i]) for i in range(2)], *[F.stddev_pop(F.col("v")[i]) for i in range(2)]).first()
    assert mean[0] == pytest.approx(0, abs=1e-9) and mean[3] == pytest.approx(1, abs=1e-9)
    new = chain.transform(rows.where("c = 'w'")).select(vector_to_array("features").alias("v")).first()["v"]
    assert len(new) == 4 and new[2:] == [0.0, 0.0]


def test_encoders(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    assert [r["label"] for r in features.label_encode(df, "s").orderBy("s").collect()] == [0, 1, 2]
    with pytest.raises(Exception, match="unknown class"):
        features.label_encode(df, "s", classes=["a", "b"]).collect()
    hot = features.one_hot(df, df.where("s <> 'c'"), "s").orderBy("s").collect()
    assert [(r["s_a"], r["s_b"]) for r in hot] == [(1, 0), (0, 1), (0, 0)]


def test_median_impute(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,), (float("nan"),)], "v double")
    assert features.mean_impute(df, df, ["v"], "median").where("v = 2.0").count() == 3
    with pytest.raises(ValueError):
        features.fit_fill(df, ["v"], "mode")


def test_vif_drops_the_combination(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=500), rng.normal(size=500)
    df = spark.createDataFrame([(float(x), float(y), float(x + y + 0.01 * z), float(z)) for x, y, z in
                                zip(a, b, rng.normal(size=500))], "a double, b double, ab double, z double")
    out = {r["feature"]: r["kept"] for r in features.reduce_vif(df, ["a", "b", "ab", "z"]).collect()}
    assert sum(out.values()) == 3 and out["z"]
    m = np.corrcoef(np.stack([a, b, rng.normal(size=500)]))
    assert features.variance_inflation(m) == pytest.approx(np.diag(np.linalg.inv(m)))


def brute_neighbours(q, d, values, k):
    out = []
    for i, row in enumerate(q):
        diff = d - row
        known = ~np.isnan(diff)
        with np.errstate(divide="ignore", invalid="ignore"):
            dist = np.where(known, diff, 0) ** 2
            dist = np.where(known.sum(1) > 0, dist.sum(1) * d.shape[1] / known.sum(1), np.inf)
        order = [j for j in np.lexsort((np.arange(len(d)), dist)) if np.isfinite(dist[j])][:k]
        out.append([values[j] for j in order])
    return out


@pytest.mark.parametrize("block_rows", [40, 20_000])
def test_neighbours_equal_brute_force(spark, block_rows):
    """Missing cells, a third of the donors on one anchor value, and queries beyond the donors' range."""
    rng = np.random.default_rng(4)
    d, q = rng.normal(size=(300, 3)), rng.normal(scale=2, size=(60, 3))
    d[:100, 0] = 0.5
    d[rng.random((300, 3)) < 0.15] = np.nan
    q[rng.random((60, 3)) < 0.2] = np.nan
    values = rng.normal(size=300)
    cast = lambda row: tuple(None if np.isnan(v) else float(v) for v in row)
    donors = spark.createDataFrame([(1000 + i, *cast(r), float(v)) for i, (r, v) in enumerate(zip(d, values))],
                                   "id bigint, x double, y double, z double, t double")
    asks = spark.createDataFrame([(i, *cast(r), None) for i, r in enumerate(q)], "id bigint, x double, y double, z double, t double")
    got = neighbours.nearest_neighbours(asks, donors, "id", ["x", "y", "z"], "t", 4, block_rows).collect()
    want = brute_neighbours(q, d, values, 4)
    for i in range(60):
        mine = [r["value"] for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["nearest"])]
        assert mine == pytest.approx(want[i])


def test_neighbours_visit_a_small_part(spark):
    """Boxes in all features rule out most cells, also where one feature tells nothing."""
    rng = np.random.default_rng(6)
    d = np.column_stack([np.full(4000, 1.0), rng.uniform(0, 100, (4000, 2))])
    donors = spark.createDataFrame([(i, *map(float, r), float(i)) for i, r in enumerate(d)], "id bigint, x double, y double, z double, t double")
    asks = donors.where("id % 40 = 0").withColumn("id", F.col("id") + 10_000)
    pairs = spark.sparkContext.accumulator(0)
    got = neighbours.nearest_neighbours(asks, donors, "id", ["x", "y", "z"], "t", 3, 100, pairs).collect()
    want = brute_neighbours(d[::40], d, np.arange(4000.0), 3)
    for i in range(100):
        assert [r["value"] for r in sorted((r for r in got if r["query_id"] == 10_000 + 40 * i), key=lambda r: r["nearest"])] == want[i]
    assert 0 < pairs.value < 0.15 * 100 * 4000


def test_chain_fills_from_neighbours(spark):
    rows = [(i, float(i % 10), 2.0 * (i % 10), "ab"[i % 2]) for i in range(60)] + [(100, 3.0, None, "a"), (101, None, 8.0, "b"), (102, None, None, "z")]
    df = spark.createDataFrame(rows, "id bigint, x double, y double, c string")
    filled = {r["id"]: r for r in neighbours.knn_impute_columns(df, df, "id", ["x", "y"], 3).collect()}
    assert filled[100]["y"] == 6.0 and filled[101]["x"] == 4.0 and filled[5]["y"] == 10.0
    assert filled[102]["x"] == pytest.approx(np.mean([r[1] for r in rows if r[1] is not None]))
    from wickline.operators.features import preprocess_by_neighbours

    out, chain = preprocess_by_neighbours(df, df.where("id < 60"), "id", ["x", "y"], ["c"], 3)
    got = {r["id"]: r["features"].toArray() for r in out.select("id", "features").collect()}
    assert len(got) == 63
    same = [i for i in range(60) if i % 10 == 3][0]
    assert np.allclose(got[100][:2], got[same][:2]) and chain.transform(out.select("id", "x", "y", "c")).count() == 63


def test_impute_falls_back_to_the_mean(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, 2.0, 20.0), (3, None, None)], "id bigint, x double, t double")
    out = neighbours.knn_impute(df, df, "id", ["x", "t"], "t", 1)
    assert {r["id"]: r["t"] for r in out.collect()} == {1: 10.0, 2: 20.0, 3: 15.0}


def test_knn_vote_ties_take_the_lowest_class(spark):
    train = spark.createDataFrame([(1, 0.0, 1), (2, 1.0, 0)], "id bigint, x double, y int")
    asks = spark.createDataFrame([(9, 0.4)], "id bigint, x double")
    assert neighbours.knn_classify(asks, train, "id", ["x"], "y", 2).first()["y_pred"] == 0


def test_training_learns_and_tunes(parts):
    ready, _ = parts
    model, history = models.train_linear(ready["train"], ready["val"], epochs=2)
    rows = {(r["step"], r["part"]): r for r in history.collect()}
    assert len(rows) == 4 and rows[(1, "val")]["accuracy"] > 0.75
    table, best = models.tune(ready["train"], ready["val"])
    trials = table.collect()
    assert len(trials) == 3 and all(1e-4 <= t["params"]["alpha"] <= 2e-4 and 0.1 <= t["params"]["power_t"] <= 0.5 for t in trials)
    assert max(t["val_accuracy"] for t in trials) == [t for t in trials if t["params"] == best][0]["val_accuracy"]
    again = models.retrain(ready["train"], best)
    prior = models.prior_baseline(ready["train"], ready["test"], LABEL, ["key"])
    base = metrics.log_loss(prior, class_p={0: "p_0", 1: "p_1"}).first()[0]
    assert metrics.log_loss(models.scored(again, ready["test"])).first()[0] < base


def test_cross_validation_covers_every_row_once(rows):
    folded = resampling.stratified_kfold(rows, "key", LABEL, 3)
    zoo = {k: v for k, v in models.model_zoo().items() if k in ("logistic", "linear_svc", "tree")}
    out = models.oof_predictions(folded, [1, 2, 3], zoo, keys=["key"], numeric=["a", "b"], categorical=["c"]).cache()
    assert {r["model"]: (r["n"], r["k"]) for r in out.groupBy("model").agg(
        F.count("*").alias("n"), F.countDistinct("key").alias("k")).collect()} == {m: (400, 400) for m in zoo}
    scores = out.groupBy("model", "fold").agg(F.avg((F.col("y") == F.col("y_pred")).cast("double")).alias("score"))
    table = {r["model"]: r for r in ranking.cv_table(scores, [1, 2, 3]).collect()}
    assert table["logistic"]["mean_cv"] > 0.75 and table["logistic"]["std_cv"] < 0.2
    assert models.cv_difference(scores, "logistic", "tree").first()["df"] == 2


def test_grid_search_ranks_settings(rows):
    from pyspark.ml.tuning import ParamGridBuilder

    tree = models.model_zoo()["tree"]
    folded = resampling.stratified_kfold(rows, "key", LABEL, 3)
    grids = {"tree": (tree, ParamGridBuilder().addGrid(tree.maxDepth, [1, 3]).build())}
    results, best = models.grid_search(folded, [1, 2, 3], numeric=["a", "b"], categorical=["c"], grids=grids)
    ranked = ranking.rank_grid(results).collect()
    assert {r["rank_test_score"] for r in ranked} == {1, 2} and set(best) == {"tree"}
    assert best["tree"].transform(rows).count() == 400


def test_bias_variance_rounds(parts):
    ready, _ = parts
    votes = models.bias_variance_fit(ready["train"], ready["test"], "key", rounds=3)
    n = ready["test"].count()
    assert {r["round"]: r["count"] for r in votes.groupBy("round").count().collect()} == {0: n, 1: n, 2: n}


def test_one_scan_predicts_like_many(parts):
    ready, _ = parts
    fitted = [models.linear_estimator(a, 10).fit(ready["train"]) for a in (1e-4, 1.0)]
    fitted.append(models.model_zoo()["tree"].fit(ready["train"]))
    fitted.append(models.model_zoo()["linear_svc"].fit(ready["train"]))
    out = models.predict_side_by_side(fitted, ready["test"], F.col("key"), "n")
    for n, m in enumerate(fitted):
        want = models.scored(m, ready["test"], None, ["key"]).select("key", "y_pred")
        got = out.where(F.col("n") == n).select("key", "y_pred")
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_stored_model_scores_the_same(spark, rows, parts, tmp_path):
    ready, chain = parts
    full = models.full_chain(chain, models.linear_estimator(iterations=30).fit(ready["train"]))
    request = rows.select("a", "b", "c")
    path = str(tmp_path / "m")
    registry.save_model(full, path, registry.signature_of(request, request))
    signature = registry.load_signature(path)
    one = scoring.batch_score(full, rows, ["key"], signature)
    two = scoring.batch_score(registry.load_model(path), rows, ["key"], signature)
    assert one.exceptAll(two).isEmpty()
    with pytest.raises(ValueError, match="missing column a"):
        scoring.batch_score(full, rows.drop("a"), ["key"], signature)
    assert registry.check_signature(rows.withColumn("b", F.lit("x")), signature) == ["column b is string, not double"]
    wide = one.select("key", "prediction", F.col("probability")[0].alias("p0"), F.col("probability")[1].alias("p1"))
    assert all(r["passed"] for r in scoring.score_checks(wide, ["p0", "p1"]).collect())


def test_a_stream_is_scored_like_a_table(spark, rows, parts, tmp_path):
    from wickline.streaming.sources import append_stream, stream_files

    ready, chain = parts
    full = models.full_chain(chain, models.linear_estimator(iterations=10).fit(ready["train"]))
    folder = str(tmp_path / "in")
    rows.repartition(3).write.parquet(folder)
    stream = stream_files(spark, folder, "*.parquet", rows.schema, per_trigger=1)
    append_stream(scoring.batch_score(full, stream, ["key"]), str(tmp_path / "out"), str(tmp_path / "c"))
    got, want = spark.read.parquet(str(tmp_path / "out")), scoring.batch_score(full, rows, ["key"])
    assert got.count() == 400 and got.exceptAll(want).isEmpty()


def test_registry_and_promotion(spark):
    t = datetime(2024, 1, 1)
    rows = spark.createDataFrame([("m", 1, "r1", "Staging", t), ("m", 1, "r1", "Production", t + timedelta(1)),
                                  ("m", 2, "r2", "Production", t + timedelta(2)), ("m", 2, "r2", "Archived", t + timedelta(3)),
                                  ("n", 1, "r3", "Staging", t)], REGISTRY_TYPES)
    assert [(r["name"], r["version"]) for r in registry.latest_production_model(rows).collect()] == [("m", 1)]
    new = registry.next_version(rows, spark.createDataFrame([("m", "r9"), ("x", "r8")], "name string, run_id string"))
    assert {r["name"]: r["version"] for r in new.collect()} == {"m": 3, "x": 1}
    live = spark.createDataFrame([("m", 1, 0.8)], "name string, version int, value double")
    for value, promote in ((0.8, False), (0.81, True)):
        cand = spark.createDataFrame([("m", 3, value), ("x", 1, 0.1)], "name string, version int, value double")
        assert {r["name"]: r["promote"] for r in registry.promotion_decision(cand, live).collect()} == {"m": promote, "x": True}
    log = spark.createDataFrame([("r", "acc", 0, 0.5), ("r", "acc", 2, 0.7), ("r", "acc", 1, 0.9)], "run_id string, name string, step int, value double")
    assert registry.latest_metrics(log).first()["value"] == 0.7


def test_run_promotes_then_keeps_the_better(spark, sf, tmp_path):
    from wickline.catalog import derived

    root, settings = str(tmp_path), TrainingSettings(trials=1, bootstrap_rounds=2)
    candles = derived.klines_stamped(spark, sf)
    first = run_training(candles, root, settings, datetime(2024, 2, 1))
    second = run_training(candles, root, settings, datetime(2024, 2, 2))
    assert (first["version"], first["promoted"], second["version"], second["promoted"]) == (1, True, 2, False)
    assert first["fingerprint"] == second["fingerprint"]
    logged = {(r["run_id"], r["name"]): r["value"] for r in spark.read.parquet(f"{root}/params").collect()}
    assert logged[(first["run_id"], "model_version")] == "1" and logged[(second["run_id"], "model_version")] == "2"
    assert logged[(first["run_id"], "bootstrap_rounds")] == "2" and (second["run_id"], "best_alpha") in logged
    tags = {(r["version"], r["run_id"]) for r in registry.version_tags(spark, root, settings.name).collect()}
    assert tags == {(1, first["run_id"]), (2, second["run_id"])}
    model, signature = production_model(spark, root, settings.name)
    assert registry.check_signature(derived.klines_cleaned(spark, sf), signature) == []
    out = serve(derived.klines_cleaned(spark, sf), root, settings.name, ["symbol", "open_time"])
    assert out.count() == derived.klines_raw(spark, sf).count()
    assert dict(out.dtypes)["probability"] == "array<double>"
    with pytest.raises(ValueError):
        production_model(spark, root, "other")


def test_p_values(spark):
    z = [1.959963985, -1.959963985, 0.0, 2.999, 3.0, 6.0, 12.0, 37.0, float("nan"), None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(z)], "i int, z double").select("i", normal_p("z").alias("p")).orderBy("i").collect()
    assert [r["p"] for r in rows[:8]] == pytest.approx([math.erfc(abs(x) / math.sqrt(2)) for x in z[:8]], rel=1e-9, abs=1e-300)
    assert rows[8]["p"] is None and rows[9]["p"] is None
    cases = [(2.776445105, 4, 0.05), (12.7062047, 1, 0.05), (2.228138852, 10, 0.05), (0.0, 3, 1.0), (1.960201264, 10000, 0.05), (1.962339, 1000, 0.05),
             (4.302652730, 2, 0.05)]
    got = spark.createDataFrame(cases, "t double, df bigint, want double").select(student_p("t", "df").alias("p"), "want").collect()
    assert [r["p"] for r in got] == pytest.approx([r["want"] for r in got], abs=1e-6)
    none = spark.createDataFrame([(1.0, 0), (None, 3), (1.0, None)], "t double, df bigint").select(student_p("t", "df")).collect()
    assert [r[0] for r in none] == [None] * 3
    df = spark.createDataFrame([(1.959963985,)], "z double")
    assert monitoring.with_normal_p(df).first()["p_value"] == pytest.approx(0.05, abs=1e-9)


def test_fingerprints_tell_cells_apart(spark):
    from wickline.sources.snapshots import fingerprint

    mark = lambda *rows: fingerprint(spark.createDataFrame(rows, "a string, b string")).first()["fingerprint"]
    odd = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("\\N", "c"), ("-", "c"), ("", "c"), ("1:a", ""), ("", "1:a")]
    assert len({mark(r) for r in odd}) == len(odd)
    assert mark(*odd) == mark(*reversed(odd)) != mark(*odd, odd[0]) and "-" in mark(*odd)


def test_pivot_refuses_what_is_not_listed(spark):
    from wickline.operators.shaping import pivot_metric

    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (2, "a", 4)], "k int, c string, n int")
    assert sorted(map(tuple, pivot_metric(df, ["k"], "c", ["a", "b"], F.sum("n")).collect())) == [(1, 2, 3), (2, 4, None)]
    for rows in (df, spark.createDataFrame([(1, "a", 2), (1, None, 3)], df.schema)):
        with pytest.raises(Exception, match="not listed"):
            pivot_metric(rows, ["k"], "c", ["a"], F.sum("n")).collect()


def test_paired_t(spark):
    df = spark.createDataFrame([(0.9, 0.8), (0.8, 0.75), (0.85, 0.8)], "a double, b double")
    d = np.array([0.1, 0.05, 0.05])
    assert models.paired_t(df, "a", "b").first()["t_stat"] == pytest.approx(d.mean() * np.sqrt(3) / d.std(ddof=1))


def test_psi_of_the_same_data_is_zero(spark):
    df = spark.range(1000).selectExpr("cast(id % 97 as double) as v", "'w' as w")
    assert monitoring.psi(df, df, "v", F.col("w")).first()["psi"] == pytest.approx(0, abs=1e-12)
    moved = df.withColumn("v", F.col("v") + 60)
    assert monitoring.psi(moved, df, "v", F.col("w")).first()["psi"] > 1


def test_training_rows_are_built_once(spark, sf):
    """The checks of the training rows read what was written; the candles below are built a single time."""
    candles = settled(klines_stamped(spark, sf), "candles")
    built = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    out = extract_training_rows(candles.mapInArrow(counted, candles.schema), TrainingSettings(rows=50))
    assert out.count() == 50
    assert built.value == candles.count()
