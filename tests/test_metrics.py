"""Metrics and curves against direct numpy computation, in one piece and in buckets."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wickline.operators import biasvariance, curves, metrics


def frame(spark, y, p, pred=None):
    pred = [int(v >= 0.5) for v in p] if pred is None else pred
    return spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, p, pred)], "y int, p double, y_pred int")


def auc_of(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def ap_of(y, p):
    out, before = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp, k = ((p >= t) & (y == 1)).sum(), (p >= t).sum()
        recall = tp / (y == 1).sum()
        out += (recall - before) * tp / k
        before = recall
    return out


def sample(kind):
    rng = np.random.default_rng(3)
    n = 600
    y = rng.integers(0, 2, n)
    if kind == "ties":
        return y, np.round(0.3 * y + 0.7 * rng.random(n), 1)
    if kind == "same":
        return y, np.full(n, 0.4)
    if kind == "ends":
        return y, np.where(rng.random(n) < 0.3, rng.integers(0, 2, n).astype(float), rng.random(n))
    return y, rng.random(n)


@pytest.mark.parametrize("kind", ["random", "ties", "same", "ends"])
@pytest.mark.parametrize("per_bucket", [40, 1_000_000])
def test_ranking_metrics(spark, kind, per_bucket):
    y, p = sample(kind)
    row = metrics.ranking_metrics(frame(spark, y, p), rows_per_bucket=per_bucket).first()
    assert row["roc_auc"] == pytest.approx(auc_of(y, p), abs=1e-12)
    assert row["average_precision"] == pytest.approx(ap_of(y, p), abs=1e-12)


def test_one_class_only_has_no_area(spark):
    row = metrics.overall_metrics(frame(spark, [1, 1, 1], [0.2, 0.5, 0.9])).first()
    assert row["roc_auc"] is None and row["accuracy"] == pytest.approx(2 / 3)


def test_log_loss_is_clipped(spark):
    got = metrics.log_loss(frame(spark, [1, 0], [0.0, 0.0])).first()[0]
    eps = metrics.EPS
    assert got == pytest.approx((-np.log(eps) - np.log(1 - eps)) / 2)


def test_golden_confusion_matrix(spark):
    """2100 training rows with counts 918, 190, 245 and 747."""
    golden = {(0, 0): 918, (0, 1): 190, (1, 0): 245, (1, 1): 747}
    rows = [(a, b, k) for (a, b), n in golden.items() for k in range(n)]
    df = spark.createDataFrame(rows, "y int, y_pred int, i int")
    assert {(r["y"], r["y_pred"]): r["n"] for r in metrics.confusion_matrix(df).collect()} == golden
    acc = metrics.accuracy(df).first()
    assert acc["accuracy"] == pytest.approx(1665 / 2100)
    assert acc["balanced_accuracy"] == pytest.approx((918 / 1108 + 747 / 992) / 2)
    assert metrics.weighted_prf(df).first()["recall"] == pytest.approx(1665 / 2100)


def test_confusion_matrix_keeps_empty_cells(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a")], "y string, y_pred string")
    got = {(r["y"], r["y_pred"]): r["n"] for r in metrics.confusion_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and sum(got.values()) == 2 and got[("c", "c")] == 0


def test_per_class_zero_denominators(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a")], "y string, y_pred string")
    got = {r["class"]: r for r in metrics.per_class_report(df).collect()}
    assert (got["b"]["precision"], got["b"]["recall"], got["b"]["f1"], got["b"]["support"]) == (0.0, 0.0, 0.0, 0)
    assert metrics.accuracy(df).first()["balanced_accuracy"] == 0.5


def test_groups_share_one_job(spark):
    y, p = sample("ties")
    df = frame(spark, y, p).withColumn("g", F.lit("x")).unionByName(
        frame(spark, 1 - y, p).withColumn("g", F.lit("y")))
    got = {r["g"]: r for r in metrics.overall_metrics(df, ["g"], "val").collect()}
    assert got["x"]["val_roc_auc"] == pytest.approx(auc_of(y, p))
    assert got["y"]["val_roc_auc"] == pytest.approx(auc_of(1 - y, p))


@pytest.mark.parametrize("per_bucket", [40, 1_000_000])
def test_curves(spark, per_bucket):
    y, p = sample("ties")
    df = frame(spark, y, p)
    pr = {r["threshold"]: r for r in curves.pr_curve(df, rows_per_bucket=per_bucket).collect()}
    assert (pr[None]["precision"], pr[None]["recall"]) == (1.0, 0.0)
    roc = {r["threshold"]: r for r in curves.roc_curve(df, rows_per_bucket=per_bucket).collect()}
    assert len(roc) == len(set(p)) + 1
    for t in set(p):
        tp = ((p >= t) & (y == 1)).sum()
        assert pr[t]["precision"] == pytest.approx(tp / (p >= t).sum())
        assert roc[t]["tpr"] == pr[t]["recall"] == pytest.approx(tp / y.sum())
        assert roc[t]["fpr"] == pytest.approx(((p >= t) & (y == 0)).sum() / (1 - y).sum())


@pytest.mark.parametrize("per_bucket", [3, 1_000_000])
def test_collinear_roc_points_are_dropped(spark, per_bucket):
    y = np.array([1, 1, 1, 0, 0, 1, 0, 0])
    p = np.array([0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2])
    got = [r["threshold"] for r in curves.roc_curve(frame(spark, y, p), rows_per_bucket=per_bucket,
                                                    drop_collinear=True).collect()]
    assert sorted(got, reverse=True) == [float("inf"), 0.9, 0.7, 0.5, 0.4, 0.2]


def test_threshold_table_and_benefit(spark):
    y, p = sample("ends")
    table = {r["threshold"]: r for r in curves.threshold_table(frame(spark, y, p), [0.0, 0.35, 1.0, 2.0]).collect()}
    for t, r in table.items():
        cells = [((p >= t) & (y == 1)).sum(), ((p >= t) & (y == 0)).sum(), ((p < t) & (y == 1)).sum(), ((p < t) & (y == 0)).sum()]
        assert [r["tp"], r["fp"], r["fn"], r["tn"]] == cells
    b = {(r["threshold"], r["structure"]): r for r in curves.benefit_structure(frame(spark, y, p), [0.35]).collect()}
    r = b[(0.35, "new_structure")]
    assert r["benefit"] == 100 * r["tp"] - 100 * r["fn"] - 2 * r["fp"] - (r["tp"] + r["fp"])


def test_best_threshold(spark):
    y, p = sample("random")
    got = {r["criterion"]: r["threshold"] for r in curves.best_threshold(frame(spark, y, p), rows_per_bucket=50).collect()}
    j = {t: ((p >= t) & (y == 1)).sum() / y.sum() - ((p >= t) & (y == 0)).sum() / (1 - y).sum() for t in p}
    assert j[got["youden"]] == pytest.approx(max(j.values()))


def test_bias_variance(spark):
    rng = np.random.default_rng(5)
    rounds, n = 8, 50
    votes, y = rng.integers(0, 3, (rounds, n)), rng.integers(0, 3, n)
    preds = spark.createDataFrame([(r, i, int(votes[r, i])) for r in range(rounds) for i in range(n)],
                                  "round int, test_id int, pred int")
    truth = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "test_id int, y int")
    main = np.array([np.argmax(np.bincount(votes[:, i])) for i in range(n)])
    got = biasvariance.bias_variance_summary(preds, truth).first()
    assert got["expected_loss"] == pytest.approx((votes != y).mean())
    assert got["bias"] == pytest.approx((main != y).mean())
    assert got["variance"] == pytest.approx((votes != main).mean())
    got = biasvariance.bias_variance_summary(preds, truth, "mse").first()
    assert got["expected_loss"] == pytest.approx(((votes - y) ** 2).mean())
    assert got["bias"] == pytest.approx(((votes.mean(0) - y) ** 2).mean())
    assert got["variance"] == pytest.approx(((votes - votes.mean(0)) ** 2).mean())
    with pytest.raises(ValueError):
        biasvariance.bias_variance_summary(preds, truth, "hinge")


def test_squared_votes_are_summed_before_the_truth_is_joined(spark):
    """One row of each test row meets the truth; repeated truths, unknown votes and infinite ones count as they did."""
    rng = np.random.default_rng(6)
    votes, y = rng.normal(1e6, 1.0, (8, 30)), rng.normal(1e6, 1.0, 30)
    preds = spark.createDataFrame([(r, i, float(votes[r, i])) for r in range(8) for i in range(30)], "round int, test_id int, pred double")
    truth = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "test_id int, y double")
    out = biasvariance.bias_variance_summary(preds, truth, "mse")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [test_id" in plan.split("Join", 1)[1]
    found = out.first()
    assert found["expected_loss"] == pytest.approx(((votes - y) ** 2).mean())
    assert found["variance"] == pytest.approx(votes.var(axis=0).mean())
    twice = biasvariance.bias_variance_summary(preds.union(preds.selectExpr("round", "test_id", "null")), truth.union(truth), "mse").first()
    assert twice["expected_loss"] == pytest.approx(found["expected_loss"])
    endless = preds.union(spark.createDataFrame([(9, 0, -math.inf)], preds.schema))
    assert biasvariance.bias_variance_summary(endless, truth, "mse").first()["expected_loss"] == math.inf
