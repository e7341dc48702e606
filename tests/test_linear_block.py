"""Blocks of linear models against models fitted one by one, and epochs against a plain loop."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wickline.operators import linear_block as lb
from wickline.operators.resampling import poisson_bootstrap


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((400, 3)) @ np.array([[1, .5, 0], [0, 1, 0], [0, 0, 2.0]])
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.0] + 0.3)))).astype(int)
    rows = [(i, x[i].tolist(), int(y[i])) for i in range(400)] + [(900, None, 1), (901, [1.0, None, 2.0], 0), (902, [1.0, 1.0, 1.0], None)]
    return x, y, spark.createDataFrame(rows, "key long, features array<double>, y int").repartition(5).persist()


def objective(c, x, y, w, l1, l2):
    z = x @ c[:-1] + c[-1]
    return (w * (np.logaddexp(0, z) - y * z)).sum() / w.sum() + l1 * np.abs(c[:-1]).sum() + l2 / 2 * (c[:-1] ** 2).sum()


def gradient(c, x, y, w, l2):
    p = 1 / (1 + np.exp(-(x @ c[:-1] + c[-1])))
    full = np.r_[(w * (p - y)) @ x, (w * (p - y)).sum()] / w.sum()
    return full + l2 * np.r_[c[:-1], 0]


def test_penalties_side_by_side_are_each_optimal(data):
    x, y, df = data
    l2, l1 = [1e-4, 1e-1, 10.0, 0.0, 0.0, 0.0, 0.01], [0.0, 0.0, 0.0, 1e-4, 1e-2, 5.0, 0.01]
    got = lb.fit_linear_block(df, l2, l1)
    for c, a, b in zip(got, l1, l2):
        g = gradient(c, x, y, np.ones(400), b)
        at_zero = np.r_[c[:-1] == 0, False]
        assert np.abs(np.where(at_zero, np.maximum(np.abs(g) - a, 0), g + a * np.r_[np.sign(c[:-1]), 0])).max() < 1e-7
    assert (got[5, :-1] == 0).all() and (got[4, :-1] != 0).any()
    p = {r.key: r.p for r in lb.predict_linear_block(df.where("key < 400"), got, ["key"]).collect()}
    assert len(p) == 400 and abs(p[3][0] - 1 / (1 + np.exp(-(x[3] @ got[0, :-1] + got[0, -1])))) < 1e-12


def test_bootstrap_rounds_in_one_scan(data):
    x, y, df = data
    rounds = 30
    got = lb.fit_linear_block(df, [0.01] * rounds, weights=lb.bootstrap_weights(rounds, F.col("key")))
    for r in (0, 7, 29):
        w = np.zeros(400)
        for row in poisson_bootstrap(df.where("key < 400"), "key", r).collect():
            w[row.key] = row.weight
        assert np.abs(gradient(got[r], x, y, w, 0.01)).max() < 1e-8
    assert np.abs(got[0] - got[1]).max() > 1e-3


def test_blocks_are_split_and_odd_tables_have_zeros(data, monkeypatch):
    _, _, df = data
    whole = lb.fit_linear_block(df, [0.1, 0.2, 0.3])
    monkeypatch.setattr(lb, "MOST_NUMBERS", 50)
    np.testing.assert_allclose(lb.fit_linear_block(df, [0.1, 0.2, 0.3]), whole, atol=1e-9)
    monkeypatch.setattr(lb, "MOST_NUMBERS", 10)
    with pytest.raises(ValueError):
        lb.fit_linear_block(df, [0.1])
    assert (lb.fit_linear_block(df.limit(0), [0.1, 1.0]) == 0).all()


def test_squared_errors_are_ridge_regression(data, monkeypatch):
    x, y, df = data
    got = lb.fit_linear_block(df, [0.5], squared=True)[0]
    one = np.column_stack([x, np.ones(400)])
    want = np.linalg.solve(one.T @ one / 400 + 0.5 * np.diag([1, 1, 1, 0]), one.T @ y / 400)
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_epochs_equal_a_plain_loop_and_go_on_from_a_table(spark, data):
    x, y, df = data
    alphas, powers, batches = [1e-4, 1e-1], [0.1, 0.5], 4
    batch_of = lambda e, k: int(hashlib.md5(f"1992:{e}:{k}".encode()).hexdigest()[:8], 16) % batches
    want = []
    for alpha, power in zip(alphas, powers):
        c, t = np.zeros(4), 0
        for e in range(3):
            for b in range(batches):
                mine = np.array([batch_of(e, k) == b for k in range(400)])
                t += 1
                c = c - 0.5 / t ** power * gradient(c, x[mine], y[mine], np.ones(mine.sum()), alpha)
        want.append(c)
    run = lambda epochs, state=None: lb.warm_epochs(df, alphas, powers, epochs, "key", state, batches)
    whole = run(3)
    first = run(2)
    second = run(1, first)
    last = {r.trial: r for r in whole.where("epoch = 2").collect()}
    for r in second.collect():
        assert (r.epoch, r.steps) == (2, 12)
        np.testing.assert_allclose(r.coefficients, last[r.trial].coefficients, atol=1e-12)
        np.testing.assert_allclose(r.coefficients, want[r.trial], atol=1e-10)
    assert {(r.epoch, r.steps) for r in whole.collect()} == {(0, 4), (1, 8), (2, 12)}
