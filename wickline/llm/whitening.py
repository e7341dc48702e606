"""Whitening of integer vectors by their leading covariance components, found by Chebyshev-filtered subspace iteration.

The covariance V is never formed. One pass over the data turns a block of trial directions Q into VQ = sum x (x'Q) / n of the
centred vectors; passes sum within tasks and then by dimension, so what meets on the driver is dimensions x block. A first
few passes bound the spectrum with a Lanczos vector that rides along. Each round then applies a Chebyshev polynomial of V,
one pass for a degree, that is small on the unwanted part of the spectrum, orthonormalises by QR, and takes the best
directions of the block by Rayleigh-Ritz, until the residuals |Vq - eq| certify the wanted ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.spans import discard, small_batches
from wickline.session import settled

#: Directions beside the wanted ones, passes that bound the spectrum, and degree of the polynomial of a round.
GUARD, BOUNDING, DEGREE = 32, 8, 10
#: Residuals, in parts of the largest eigenvalue, that certify the components, and at which rounding leaves nothing to gain.
CERTIFIED, SETTLED = 1e-12, 1e-14
ROUNDS = 60
#: Eigenvalues below this part of the largest one count as no variance.
NO_VARIANCE = 1e-12
#: Vectors in one packed row of the fit list.
PACKED = 4096
#: Greatest size of an entry.
LARGEST = 1 << 31


@dataclass
class Whitening:
    """Means and components; every field is of the size of the dimensions, not of the data."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int
    identity_error: float = 0.0

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace else 0.0 for e in self.values]


def grid_vectors(rows: DataFrame, vector: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """All columns of ``rows`` but ``vector``, and ``x`` = floor(scale c) + offset for its entries c as doubles (replaced if there).

    Rows whose vector is null or holds a null, NaN, infinite, or too large (``LARGEST``) entry are left out.
    """
    v = F.col(vector).cast("array<double>")
    sound = F.coalesce(~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c * scale + offset) >= LARGEST)), F.lit(False))
    x = F.transform(v, lambda c: F.floor(c * scale) + F.lit(offset).cast("long"))
    return rows.where(sound).withColumn("x", x).drop(*({vector} - {"x"}))


def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(0))
        blocks = [x[i:i + PACKED].tobytes() for i in range(0, len(x), PACKED)]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["block"])


def numerators(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S without rounding: whole numbers of 64 bits, or Python's where these might not hold them."""
    if n * int(np.abs(x).max(initial=0)) >= 1 << 62:
        x, sums = x.astype(object), np.array(sums.tolist(), dtype=object)
    return x * n - sums


def _per_dimension(batches: Iterator[pa.RecordBatch], d: int, work: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The sum of ``work`` over a task's blocks of vectors, one row for each of its rows."""
    total = None
    for batch in batches:
        for block in batch.column(0).to_pylist():
            part = work(np.frombuffer(block, dtype=np.int64).reshape(-1, d))
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(list(total))], names=["i", "v"])


def _summed(fit: DataFrame, d: int, width: int, work: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """``work`` summed over the whole fit list: rows of ``width`` numbers, summed by row in Spark."""
    parts = fit.mapInArrow(partial(_per_dimension, d=d, work=work), f"i long, v array<{kind}>")
    found = parts.groupBy("i").agg(*[F.sum(F.col("v")[k]).alias(f"s{k}") for k in range(width)]).toArrow().sort_by("i")
    return np.stack([found.column(f"s{k}").to_numpy() for k in range(width)], axis=1)


def _sums(x: np.ndarray) -> np.ndarray:
    return np.stack([x.sum(axis=0), np.full(x.shape[1], len(x))], axis=1)


def _product(x: np.ndarray, q: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n VQ of a block's rows, and beside it n times the variance of each dimension."""
    centred = numerators(x, n, sums).astype(np.float64) / n
    return np.column_stack([centred.T @ (centred @ q), (centred * centred).sum(axis=0)])


def _moments(x: np.ndarray, w: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    whitened = (numerators(x, n, sums).astype(np.float64) / n) @ w
    return np.column_stack([whitened.T @ whitened, whitened.sum(axis=0)])


def _ritz(q: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values of a block by falling size, the block turned to its Ritz vectors, and V times these."""
    h = q.T @ z
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, z @ turn


def leading_components(times: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, guard: int = GUARD,
                       degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Eigenvalues and unit eigenvectors (columns) of the ``wanted`` largest, the largest residual, and the passes.

    ``times`` multiplies the matrix, symmetric and with no negative eigenvalue, with a block of columns.
    """
    rng = np.random.default_rng(11)
    size, passes = min(d, wanted + guard), 1
    q = np.linalg.qr(rng.standard_normal((d, size)))[0]
    low, high = 0.0, 0.0
    if size < d:
        # Plain subspace steps, beside which a Lanczos vector bounds the spectrum.
        v = rng.standard_normal(d)
        basis, diagonal, off = [v / np.linalg.norm(v)], [], []
        for _ in range(min(BOUNDING, d - 1)):
            z = times(np.column_stack([q, basis[-1]]))
            passes += 1
            q, w = np.linalg.qr(z[:, :-1])[0], z[:, -1]
            diagonal.append(float(basis[-1] @ w))
            for _ in range(2):
                w = w - np.column_stack(basis) @ (np.column_stack(basis).T @ w)
            off.append(float(np.linalg.norm(w)))
            if off[-1] <= SETTLED * max(diagonal):
                break
            basis.append(w / off[-1])
        ends = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off[:len(diagonal) - 1], 1) + np.diag(off[:len(diagonal) - 1], -1))
        low, high = max(0.0, ends[0] - off[-1]), ends[-1] + off[-1]
    values, q, z = _ritz(q, times(q))
    best = np.inf
    for _ in range(ROUNDS):
        top = max(values[0], 0.0)
        residual = float(np.linalg.norm(z[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max(initial=0.0))
        done = residual <= CERTIFIED * top and residual > best / 2
        if size == d or top == 0 or residual <= SETTLED * top or done:
            break
        best = min(best, residual)
        cut = float(values[-1])
        if not low < cut < values[0]:
            low, cut = 0.0, max(cut, np.finfo(float).tiny)
        half, centre = (cut - low) / 2, (cut + low) / 2
        sigma = half / (max(high, values[0]) - centre)
        tau = 2 / sigma
        before, now = q, (z - centre * q) * (sigma / half)
        for _ in range(degree - 1):
            ahead = 1 / (tau - sigma)
            before, now = now, (times(now) - centre * now) * (2 * ahead / half) - sigma * ahead * before
            sigma = ahead
            passes += 1
        q = np.linalg.qr(now)[0]
        values, q, z = _ritz(q, times(q))
        passes += 1
    if size < d and residual > CERTIFIED * top:
        raise ArithmeticError(f"components not certified: residual {residual} of {top}")
    return values[:wanted], q[:, :wanted], residual, passes


def fit_whitening(vectors: DataFrame, components: int = 16, guard: int = GUARD, degree: int = DEGREE) -> Whitening | None:
    """The whitening of the distinct vectors in ``x`` (array<long>), each counted once; None if there are none.

    Vectors of another length than most have (of equally frequent lengths the greater) take no part, nor do null and empty
    ones; other columns are ignored. Copies collapse in the map tasks. Components of no variance have the eigenvalue 0.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    distinct = settled(vectors.where(F.size("x") > 0).select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "distinct")
    lengths = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        discard(spark, distinct)
        return None
    d = lengths[0].d
    fit = settled(distinct.where(F.size("x") == d).mapInArrow(_pack, "block binary"), "fit")
    discard(spark, distinct)
    counted = _summed(fit, d, 2, _sums, "long")
    sums, n = counted[:, 0], int(counted[0, 1])
    variances = np.zeros(d)

    def times(q: np.ndarray) -> np.ndarray:
        found = _summed(fit, d, q.shape[1] + 1, partial(_product, q=q, n=n, sums=sums)) / n
        variances[:] = found[:, -1]
        return found[:, :-1]

    wanted = min(components, d)
    values, q, residual, passes = leading_components(times, d, wanted, guard, degree)
    values = np.where(values > NO_VARIANCE * max(values[0], 0.0), values, 0.0)
    model = Whitening(n, sums, values, q, float(variances.sum()), residual, passes)
    live = values > 0
    if live.any():
        w = q[:, live] / np.sqrt(values[live])
        found = _summed(fit, d, w.shape[1] + 1, partial(_moments, w=w, n=n, sums=sums)) / n
        mean = found[:, -1]
        model.identity_error = float(np.abs(found[:, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max())
    discard(spark, fit)
    return model


def _project(batches: Iterator[pa.RecordBatch], names: list[str], model: Whitening) -> Iterator[pa.RecordBatch]:
    live = model.values > 0
    w = model.vectors[:, live] / np.sqrt(model.values[live])
    d = len(model.sums)
    for batch in batches:
        column = batch.column("x")
        fits = np.array([x is not None and x == d for x in column.value_lengths().to_pylist()], dtype=bool)
        whitened, deviation = [None] * len(column), [None] * len(column)
        if fits.any():
            num = numerators(_matrix(column.filter(pa.array(fits))), model.n, model.sums)
            small = num.dtype != object and d * int(np.abs(num).max()) ** 2 < 1 << 63
            squares = (num * num).sum(axis=1).tolist() if small else [sum(a * a for a in row) for row in num.tolist()]
            out = np.full((len(num), len(live)), np.nan)
            out[:, live] = (num.astype(np.float64) / model.n) @ w
            for i, s, row in zip(np.flatnonzero(fits).tolist(), squares, out.tolist()):
                deviation[i] = s if s < 1 << 63 else None
                whitened[i] = [x if ok else None for x, ok in zip(row, live.tolist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(whitened, pa.list_(pa.float64())),
                                          pa.array(deviation, pa.int64())], names=[*names, "whitened", "deviation"])


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """Every row with ``whitened`` (its centred x on each component, over the root of the eigenvalue) and ``deviation``
    (the sum over dimensions of (n x - S)^2, exact), replaced if there.

    Both are null for a null ``x`` or one of another length than the model's. A component of no variance has a null in its place, a
    deviation beyond a long is null. Repeated rows are projected each; an empty table, or no model, gives an empty result.
    """
    vectors = vectors.drop("whitened", "deviation")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in vectors.schema.fields) + "whitened array<double>, deviation long"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    small_batches(vectors.sparkSession)
    return vectors.mapInArrow(partial(_project, names=vectors.columns, model=model), schema)


def by_component(whitened: DataFrame, model: Whitening | None) -> DataFrame:
    """One row for each whitened vector and component, numbered from 1, with n, explained and identity_error."""
    explained: Column = F.array(*[F.lit(e) for e in model.explained]) if model else F.array().cast("array<double>")
    one = whitened.select(
        *[c for c in whitened.columns if c not in ("whitened", "x")], F.posexplode("whitened").alias("place", "whitened"))
    return one.select(
        *[c for c in one.columns if c not in ("place", "whitened")], (F.col("place") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"), "whitened", F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"))
