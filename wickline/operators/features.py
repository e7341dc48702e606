"""Feature preparation: fitted on the training rows as a few numbers, applied as projections."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline import schemas
from wickline.operators.running import exact_quantiles, ordered_sums
from wickline.session import settled
from wickline.small import broadcast_table_if_small


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column; a constant column gets deviation 1."""
    one = train.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (one[f"m_{c}"] or 0.0, one[f"s_{c}"] or 1.0) for c in columns}


def standard_scale(df: DataFrame, train: DataFrame, columns: Sequence[str], with_mean: bool = True,
                   with_std: bool = True) -> DataFrame:
    """Centre and scale columns by the statistics of the training rows."""
    fitted = fit_scaler(train, columns)
    return df.withColumns({
        c: (F.col(c) - F.lit(m if with_mean else 0.0)) / F.lit(s if with_std else 1.0) for c, (m, s) in fitted.items()})


def fit_fill(train: DataFrame, columns: Sequence[str], strategy: str = "mean") -> dict[str, float]:
    """The value that replaces a missing cell of each column."""
    if strategy == "mean":
        one = train.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(c) for c in columns])
        return one.first().asDict()
    if strategy == "median":
        return {r["column"]: r["q0"] for r in exact_quantiles(train, columns, [0.5]).collect()}
    raise ValueError(f"strategy is mean or median, not {strategy}")


def mean_impute(df: DataFrame, train: DataFrame, columns: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Replace NULL and NaN cells by the mean or the exact median of the training rows."""
    fills = fit_fill(train, columns, strategy)
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(v))
                           for c, v in fills.items()})


def fit_categories(train: DataFrame, column: str) -> DataFrame:
    """The distinct values of a categorical column with their place, from 0, in ascending order: (__class, __code)."""
    found = settled(train.where(F.col(column).isNotNull()).select(F.col(column).alias("__class")).distinct(), "categories")
    placed = ordered_sums(found.withColumn("__one", F.lit(1)), [F.col("__class")], {"__place": "__one"})
    return placed.select("__class", (F.col("__place") - 1).cast("int").alias("__code"))


def one_hot(df: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """A 0/1 column per category seen in training; an unseen value gets zeros everywhere.

    The categories become column names and so pass through the driver; :func:`preprocess_chain` keeps very many of
    them in one sparse vector.
    """
    seen = sorted(r["__class"] for r in fit_categories(train, column).collect())
    return df.select("*", *[F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in seen])


def label_encode(df: DataFrame, column: str, name: str = "label", classes: list | None = None) -> DataFrame:
    """Sorted classes to 0..n-1; NULL, or a value outside the given classes, is an error."""
    if classes:
        kind = df.schema[column].dataType.simpleString()
        known = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(classes)], f"__class {kind}, __code int")
    else:
        known = fit_categories(df, column)
    refuse = F.raise_error(F.concat(F.lit("unknown class "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))).cast("int")
    coded = df.join(broadcast_table_if_small(known), F.col(column) == F.col("__class"), "left")
    return coded.select(*[c for c in df.columns if c != name], F.coalesce("__code", refuse).alias(name))


def _quoted(name: str) -> str:
    return f"`{name}`"


def numeric_stage(train: DataFrame, columns: Sequence[str], strategy: str = "mean") -> Transformer:
    """Impute and scale as one storable SQL stage; outputs ``<column>_scaled``."""
    fills = fit_fill(train, columns, strategy)
    filled = mean_impute(train, train, columns, strategy) if any(v is not None for v in fills.values()) else train
    scales = fit_scaler(filled, columns)
    cells = [
        f"(coalesce(nanvl(cast({_quoted(c)} as double), cast(null as double)), {fills[c]!r}D) - {m!r}D) / {s!r}D "
        f"as {_quoted(c + '_scaled')}" for c, (m, s) in scales.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(cells)} FROM __THIS__")


def preprocess_chain(train: DataFrame, numeric: Sequence[str] = tuple(schemas.FEATURES),
                     categorical: Sequence[str] = (), output: str = "features",
                     strategy: str = "mean") -> PipelineModel:
    """Numeric and categorical branches assembled into one vector, fitted on the training rows only."""
    stages: list = [numeric_stage(train, numeric, strategy)]
    inputs = [f"{c}_scaled" for c in numeric]
    if categorical:
        codes, hots = [f"{c}_code" for c in categorical], [f"{c}_hot" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=codes, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=codes, outputCols=hots, dropLast=True))
        inputs += hots
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return Pipeline(stages=stages).fit(train)


def preprocess_by_neighbours(df: DataFrame, train: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                             k: int = 5) -> tuple[DataFrame, PipelineModel]:
    """``preprocess_chain`` with missing numbers filled from the ``k`` nearest training rows: the transformed rows of ``df`` and the
    chain, which is fitted on the filled training rows and scales and encodes. Keys are whole numbers."""
    from wickline.operators.neighbours import knn_impute_columns

    chain = preprocess_chain(settled(knn_impute_columns(train, train, key, numeric, k), "filled"), numeric, categorical)
    return chain.transform(knn_impute_columns(df, train, key, numeric, k)), chain


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """The d x d Pearson matrix from one aggregate pass."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i)]
    one = df.agg(F.count("*"), *[F.corr(columns[i], columns[j]).alias(f"r{i}_{j}") for i, j in pairs]).first()
    matrix = np.eye(len(columns))
    for i, j in pairs:
        matrix[i, j] = matrix[j, i] = one[f"r{i}_{j}"]
    return matrix


def variance_inflation(matrix: np.ndarray) -> np.ndarray:
    """Inflation factor of each column of a correlation matrix; infinite where it is a combination of others."""
    d = len(matrix)
    factors = np.empty(d)
    for i in range(d):
        rest = [j for j in range(d) if j != i]
        if not rest:
            factors[i] = 1.0
            continue
        weights, *_ = np.linalg.lstsq(matrix[np.ix_(rest, rest)], matrix[rest, i], rcond=None)
        left = 1.0 - float(matrix[rest, i] @ weights)
        factors[i] = np.inf if left < 1e-12 else 1.0 / left
    return factors


def reduce_vif(df: DataFrame, columns: Sequence[str], limit: float = 10.0, max_removed: int = 20) -> DataFrame:
    """Drop the column with the greatest inflation until all are at most ``limit``.

    The data is read once; dropping a column only drops a row and column of the matrix.
    """
    matrix, alive, dropped = correlation_matrix(df, columns), list(range(len(columns))), []
    while len(alive) > 1 and len(dropped) < max_removed:
        factors = variance_inflation(matrix[np.ix_(alive, alive)])
        worst = int(np.argmax(factors))
        if factors[worst] <= limit:
            break
        dropped.append((columns[alive[worst]], len(dropped) + 1, float(factors[worst])))
        alive.pop(worst)
    final = variance_inflation(matrix[np.ix_(alive, alive)])
    rows = [(c, False, n, v) for c, n, v in dropped] + [(columns[i], True, None, float(v)) for i, v in zip(alive, final)]
    return df.sparkSession.createDataFrame(rows, "feature string, kept boolean, step int, vif double")
