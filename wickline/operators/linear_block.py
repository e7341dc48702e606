"""Many linear models in one scan: bootstrap rounds, penalties and trials as columns of one block of weights.

Each pass over the rows sums, for every model at once, the loss, the gradient and (for Newton steps) the curvature; tasks add up
their rows and Spark the tasks, so what meets on the driver is models x (features + 1)^2 numbers, whatever the rows.
Blocks of more models than ``MOST_NUMBERS`` allows are fitted one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from wickline.functions.hashing import hashed_int, hashed_uniform, poisson_weight
from wickline.session import settled

#: Numbers that a task holds for its block of models.
MOST_NUMBERS = 2_000_000
#: Newton passes, and the change in the objective, in parts of it, below which a model is done.
PASSES, ENOUGH = 60, 1e-12
#: Rows that are worked on at once.
ROWS = 2048


def plain_features(df: DataFrame, features: str = "features") -> Column:
    """A feature column as array<double>, also from an ML vector."""
    if isinstance(df.schema[features].dataType, ArrayType):
        return F.col(features).cast("array<double>")
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(features)


def bootstrap_weights(rounds: int, key: Column, seed: int = 42) -> Column:
    """One Poisson(1) weight for each round, as ``poisson_bootstrap`` draws them, in an array."""
    drawn = F.transform(F.sequence(F.lit(0), F.lit(rounds - 1)), lambda r: hashed_uniform(seed, r, key))
    return F.transform(drawn, lambda u: poisson_weight(u).cast("tinyint"))  # apart, so that each hash is worked out once


def _pieces(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Features with a one behind them, labels and weights of some rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            w = part.column("w").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), -1) if "w" in part.schema.names else None
            yield np.column_stack([x, np.ones(len(x))]), part.column("y").to_numpy(zero_copy_only=False).astype(np.float64), w


def _sums(batches: Iterator[pa.RecordBatch], coefficients: np.ndarray, squared: bool, curved: bool, first: int) -> Iterator[pa.RecordBatch]:
    """For each model: loss, weight, gradient and curvature of a task's rows."""
    models, width = coefficients.shape
    total = np.zeros((models, 2 + width + (width * width if curved else 0)))
    for x, y, w in _pieces(batches, width - 1):
        z = x @ coefficients.T
        w = np.ones_like(z) if w is None else w[:, first:first + models]
        if squared:
            off, bend, loss = z - y[:, None], np.ones_like(z), (z - y[:, None]) ** 2 / 2
        else:
            p = 0.5 * (1 + np.tanh(z / 2))
            off, bend, loss = p - y[:, None], p * (1 - p), np.logaddexp(0, z) - y[:, None] * z
        sums = [(w * loss).sum(axis=0)[:, None], w.sum(axis=0)[:, None], (w * off).T @ x]
        if curved:
            sums.append((w * bend).T @ (x[:, :, None] * x[:, None, :]).reshape(len(x), -1))
        total += np.concatenate(sums, axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(models)), pa.array(list(total))], names=["model", "v"])


def _summed(rows: DataFrame, coefficients: np.ndarray, squared: bool, curved: bool, first: int = 0) -> tuple[np.ndarray, ...]:
    found = rows.mapInArrow(partial(_sums, coefficients=coefficients, squared=squared, curved=curved, first=first),
                            "model long, v array<double>").select("model", F.posexplode("v")).groupBy("model", "pos").agg(
        F.sum("col").alias("v")).toArrow()
    models, width = coefficients.shape
    table = np.zeros((models, 2 + width + (width * width if curved else 0)))
    table[found.column("model").to_numpy(), found.column("pos").to_numpy()] = found.column("v").to_numpy()
    return table[:, 0], table[:, 1], table[:, 2:2 + width], table[:, 2 + width:].reshape(models, width, width) if curved else None


def _penalty(c: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    return l1 * np.abs(c[:, :-1]).sum(axis=1) + l2 / 2 * (c[:, :-1] ** 2).sum(axis=1)


def _newton_step(c: np.ndarray, gradient: np.ndarray, curve: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The minimum of each model's quadratic with its penalties, by coordinate descent where there is an L1 part."""
    width = c.shape[1]
    free = np.ones(width)
    free[-1] = 0
    gradient = gradient + l2[:, None] * free * c
    curve = curve + l2[:, None, None] * np.diag(free) + 1e-12 * np.trace(curve, axis1=1, axis2=2)[:, None, None] * np.eye(width) + 1e-300 * np.eye(width)
    step = -np.linalg.solve(curve, gradient[:, :, None])[:, :, 0]
    lasso = np.flatnonzero(l1 > 0)
    if len(lasso):
        g, h, base, bound = gradient[lasso], curve[lasso], c[lasso], l1[lasso]
        delta = np.zeros_like(g)
        for _ in range(1000):
            before = delta.copy()
            for j in range(width):
                slope, bend = g[:, j] + (h[:, j] * delta).sum(axis=1), h[:, j, j]
                goal = base[:, j] + delta[:, j] - slope / bend
                if j < width - 1:
                    goal = np.sign(goal) * np.maximum(np.abs(goal) - bound / bend, 0)
                delta[:, j] = goal - base[:, j]
            if np.abs(delta - before).max() <= 1e-13 * max(1.0, np.abs(base + delta).max()):
                break
        step[lasso] = delta
    return step


def fit_linear_block(df: DataFrame, l2: Sequence[float], l1: Sequence[float] | None = None, features: str = "features",
                     label: str = "y", weights: Column | None = None, squared: bool = False, passes: int = PASSES) -> np.ndarray:
    """Coefficients, the intercept last, of one model for each penalty: models x (features + 1).

    The loss (logistic, or half the squared error) is the weighted mean over the rows, plus l1 |c| and l2 / 2 |c|^2 without the
    intercept. ``weights`` is an array with a weight for each model (bootstrap counts, folds); without it all are 1.
    A model without weight, as in an empty table, has zeros. Rows of a null label or feature take no part. Each pass is a
    damped Newton step of all models; a model whose objective rose goes back half its step.
    """
    l2, l1 = np.asarray(l2, dtype=float), np.zeros(len(l2)) if l1 is None else np.asarray(l1, dtype=float)
    columns = [plain_features(df, features).alias("x"), F.col(label).cast("double").alias("y"), *([weights.alias("w")] if weights is not None else [])]
    rows = settled(df.select(*columns).where("y is not null and x is not null and not exists(x, c -> c is null or isnan(c))"), "block-rows")
    one = rows.select(F.size("x").alias("d")).first()
    if one is None:
        return np.zeros((len(l2), 1))
    width = one.d + 1
    numbers = 2 + width + width * width
    if numbers > MOST_NUMBERS:
        raise ValueError(f"{width - 1} features are too many for exact curvature")
    most, out = MOST_NUMBERS // numbers, []
    for first in range(0, len(l2), most):
        a, b = l1[first:first + most], l2[first:first + most]
        c = np.zeros((len(b), width))
        last, step, best = c.copy(), np.zeros_like(c), np.full(len(b), np.inf)
        done = np.zeros(len(b), dtype=bool)
        for _ in range(passes):
            loss, weight, gradient, curve = _summed(rows, c, squared, True, first)
            weight = np.where(weight > 0, weight, 1.0)
            value = loss / weight + _penalty(c, a, b)
            worse = value > best + 1e-15 * np.abs(best)
            done |= ~worse & (best - value <= ENOUGH * np.abs(value))
            step = np.where(worse[:, None], step / 2, _newton_step(c, gradient / weight[:, None], curve / weight[:, None, None], a, b))
            last = np.where(worse[:, None], last, c)
            best = np.where(worse, best, value)
            done |= np.abs(step).max(axis=1) <= 1e-14 * np.maximum(1.0, np.abs(last).max(axis=1))
            c = np.where(done[:, None], last, last + step)
            if done.all():
                break
        out.append(last)
    return np.concatenate(out)


def _predict(batches: Iterator[pa.RecordBatch], coefficients: np.ndarray, names: list[str], squared: bool) -> Iterator[pa.RecordBatch]:
    d = coefficients.shape[1] - 1
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        z = x @ coefficients[:, :-1].T + coefficients[:, -1]
        p = z if squared else 0.5 * (1 + np.tanh(z / 2))
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(list(p), pa.list_(pa.float64()))], names=[*names, "p"])


def predict_linear_block(df: DataFrame, coefficients: np.ndarray, keep: Sequence[str], features: str = "features", squared: bool = False) -> DataFrame:
    """The columns ``keep`` and ``p``, an array with every model's probability (or value), from one scan. Rows of null features are
    left out."""
    rows = df.select(*keep, plain_features(df, features).alias("x")).where("x is not null")
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name != "x")
    return rows.mapInArrow(partial(_predict, coefficients=coefficients, names=list(keep), squared=squared), f"{kept}p array<double>")


def warm_epochs(df: DataFrame, alphas: Sequence[float], power_ts: Sequence[float], epochs: int, key: str, state: DataFrame | None = None,
                batches: int = 10, eta0: float = 0.5, features: str = "features", label: str = "y", seed: int = 1992) -> DataFrame:
    """The state (epoch, trial, steps, coefficients) after each epoch of mini-batch descent, for all trials side by side.

    A trial has an L2 strength and a decay: step t moves by eta0 / t^power_t against the mean gradient of its batch. Rows are dealt
    to ``batches`` by a hash of their key, anew in each epoch, and one scan of a batch serves all trials. With ``state``, an earlier
    result, the epochs go on from its last one, so stopping and going on equals one run. An empty batch makes no step.
    """
    spark: SparkSession = df.sparkSession
    rows = settled(df.select(F.col(key).alias("key"), plain_features(df, features).alias("x"), F.col(label).cast("double").alias("y")).where(
        "y is not null and x is not null and not exists(x, c -> c is null or isnan(c))"), "epoch-rows")
    one = rows.select(F.size("x").alias("d")).first()
    width = (one.d if one else 0) + 1
    alpha, power = np.asarray(alphas, dtype=float)[:, None], np.asarray(power_ts, dtype=float)
    c, steps, done = np.zeros((len(alphas), width)), 0, 0
    if state is not None and (top := state.agg(F.max("epoch")).first()[0]) is not None:
        held = state.where(F.col("epoch") == top).orderBy("trial").collect()  # one row for each trial
        c, steps, done = np.array([r.coefficients for r in held]), held[0].steps, top + 1
    found = []
    for epoch in range(done, done + epochs):
        dealt = rows.withColumn("batch", hashed_int(seed, F.lit(epoch), F.col("key")) % batches)
        for batch in range(batches):
            _, weight, gradient, _ = _summed(dealt.where(F.col("batch") == batch).select("x", "y"), c, False, False)
            if weight[0] == 0:
                continue
            steps += 1
            gradient = gradient / weight[:, None]
            gradient[:, :-1] += alpha * c[:, :-1]
            c = c - (eta0 / steps ** power)[:, None] * gradient
        found += [(epoch, trial, steps, row.tolist()) for trial, row in enumerate(c)]
    return spark.createDataFrame(found, "epoch int, trial int, steps int, coefficients array<double>")
