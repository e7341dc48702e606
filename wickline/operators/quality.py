"""Schema, null, range and duplicate checks, statistics, gaps and frame comparison.

Every validator is one aggregate pass that ends in a few rows; raising is a separate step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_FRACTIONAL = ("float", "double")


def _breaks(df: DataFrame, name: str, kind: str) -> Column:
    """True where a present value does not satisfy the declared kind under the lax rules."""
    actual, c = dict(df.dtypes)[name], F.col(name)
    integral = actual in _INTEGRAL or actual == "boolean"
    fractional = actual in _FRACTIONAL or actual.startswith("decimal")
    if kind == "int":
        if integral:
            return F.lit(False)
        if fractional:
            return ~c.try_cast("double").eqNullSafe(F.floor(c).cast("double"))
        return ~F.trim(c).rlike("^[+-]?[0-9]+$") if actual == "string" else F.lit(True)
    if kind == "float":
        if integral or fractional:
            return F.lit(False)
        return c.try_cast("double").isNull() if actual == "string" else F.lit(True)
    if kind == "str":
        return F.lit(actual != "string")
    if kind == "bool":
        return F.lit(actual != "boolean")
    if kind == "datetime":
        if actual in ("timestamp", "timestamp_ntz", "date") or integral or fractional:
            return F.lit(False)
        return c.try_cast("timestamp_ntz").isNull() if actual == "string" else F.lit(True)
    raise ValueError(f"unknown type {kind}")


def _missing(df: DataFrame, name: str) -> Column:
    empty = F.col(name).isNull()
    return empty | F.isnan(name) if dict(df.dtypes)[name] in _FRACTIONAL else empty


def _rows_of(one: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return one.select(F.inline(F.array(*entries)))


def validate_schema(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Per declared column: is it there, and how many rows break its rule (NULL breaks every rule).

    Extra columns are ignored; text columns holding numbers are not checked to be numeric, so raw
    prices pass here and fail in the cast.
    """
    present = [c for c in declared if c in df.columns]
    bad = [F.count_if(F.col(c).isNull() | _breaks(df, c, declared[c])).alias(f"bad_{c}") for c in present]
    one = df.agg(F.count("*").alias("__rows"), *bad)
    return _rows_of(one, [F.struct(
        F.lit(c).alias("column"), F.lit(kind).alias("declared"), F.lit(c in present).alias("present"),
        (F.col(f"bad_{c}") if c in present else F.col("__rows")).alias("failures"))
        for c, kind in declared.items()])


def violations(df: DataFrame, declared: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """The offending cells: key, column, rule and the value as text."""
    found = []
    for c, kind in declared.items():
        if c not in df.columns:
            continue
        rule = F.when(F.col(c).isNull(), "null").when(_breaks(df, c, kind), F.lit(f"not {kind}"))
        found.append(F.when(rule.isNotNull(), F.struct(
            F.lit(c).alias("column"), rule.alias("rule"), F.col(c).cast("string").alias("value"))))
    return df.select(*keys, F.inline(F.array_compact(F.array(*found))))


def validate_non_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing cells per column; NaN counts as missing."""
    one = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in columns])
    return _rows_of(one, [F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns])


class FrameValidator:
    """Collects column, type and missing-value checks and answers them in one pass."""

    def __init__(self, df: DataFrame):
        self._df, self._checks = df, []

    def columns(self, names: Sequence[str]) -> FrameValidator:
        for c in names:
            self._checks.append(("column", c, F.lit(0 if c in self._df.columns else 1).cast("bigint")))
        return self

    def types(self, declared: dict[str, str]) -> FrameValidator:
        for c, kind in declared.items():
            if c in self._df.columns:
                self._checks.append(("type", c, F.count_if(F.col(c).isNotNull() & _breaks(self._df, c, kind))))
        return self

    def missing(self, names: Sequence[str]) -> FrameValidator:
        for c in names:
            if c in self._df.columns:
                self._checks.append(("missing", c, F.count_if(_missing(self._df, c))))
        return self

    def result(self) -> DataFrame:
        one = self._df.agg(*[F.max(m).alias(f"m{i}") if k == "column" else m.alias(f"m{i}")
                             for i, (k, _, m) in enumerate(self._checks)])
        return _rows_of(one, [F.struct(F.lit(k).alias("check"), F.lit(c).alias("column"),
                                       F.coalesce(F.col(f"m{i}"), F.lit(0)).alias("failures"))
                              for i, (k, c, _) in enumerate(self._checks)])


def validate_frame(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Columns, then types, then missing values of a declared layout."""
    return FrameValidator(df).columns(list(declared)).types(declared).missing(list(declared)).result()


def ensure_valid(report: DataFrame) -> None:
    """Raise with the names of the failing columns. The report has one row per check."""
    failed = sorted({r["column"] for r in report.where("failures > 0").select("column").collect()})
    if failed:
        raise ValueError(f"validation failed for columns: {', '.join(failed)}")


def drift_zscore(df: DataFrame, baseline: dict[str, float], limit: float = 3.0) -> DataFrame:
    """Shift of each column's mean from its baseline in sample standard deviations."""
    one = df.agg(*[f(c).alias(f"{n}_{c}") for c in baseline for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    rows = _rows_of(one, [F.struct(
        F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"), F.lit(float(b)).alias("baseline"),
        F.try_divide(F.abs(F.col(f"m_{c}") - F.lit(float(b))), F.col(f"s_{c}")).alias("z"))
        for c, b in baseline.items()])
    return rows.withColumn("drifted", F.coalesce(F.col("z") > F.lit(float(limit)), F.lit(False)))


def expect_mean_between(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Mean of each column and whether it lies in its closed range."""
    one = df.agg(*[F.avg(c).alias(c) for c in ranges])
    return _rows_of(one, [F.struct(F.lit(c).alias("column"), F.col(c).alias("mean"),
                                   F.coalesce(F.col(c).between(float(lo), float(hi)), F.lit(False)).alias("passed"))
                          for c, (lo, hi) in ranges.items()])


def quality_gate(df: DataFrame, rules: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """Rows failing each named condition (NULL fails), and surplus rows per key."""
    one = df.agg(*[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()])
    checked = _rows_of(one, [F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in rules])
    copies = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failures"))
    both = checked.unionByName(copies.select(F.lit("duplicate_key").alias("rule"), "failures"))
    return both.withColumn("passed", F.col("failures") == 0)


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation and range of each column, in one pass."""
    stats = [("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("low", F.min), ("high", F.max)]
    one = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in stats])
    return _rows_of(one, [F.struct(F.lit(c).alias("column"), *[
        F.col(f"{n}_{c}").cast("bigint" if n == "n" else "double").alias(n) for n, _ in stats]) for c in columns])


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int,
              keys: Sequence[str] = ()) -> DataFrame:
    """Rows per equal-width bin; bin 0 and bin n+1 hold what lies outside."""
    slot = F.width_bucket(F.col(column), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).alias("bin")
    return df.groupBy(*keys, slot).agg(F.count("*").alias("rows"))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, all in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    return _rows_of(one, [F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"{a}__{b}").alias("corr"))
                          for a, b in pairs])


def find_gaps(candles: DataFrame, interval_ms: int, key: str = "symbol", time: str = "open_time",
              slots: int = 1440) -> DataFrame:
    """Stretches without candles between two candles of a series.

    A series may be most of the table, so neighbours are looked up inside blocks of ``slots``
    intervals; only the first and last candle of each block meet over the whole series.
    """
    block = F.floor(F.col(time) / F.lit(interval_ms * slots)).alias("block")
    seen = candles.select(key, time, block).distinct()
    inner = seen.withColumn("after", F.lag(time).over(Window.partitionBy(key, "block").orderBy(time)))
    ends = candles.groupBy(key, block).agg(F.min(time).alias("first"), F.max(time).alias("last"))
    outer = ends.select(key, F.col("first").alias(time),
                        F.lag("last").over(Window.partitionBy(key).orderBy("block")).alias("after"))
    steps = inner.select(key, time, "after").unionByName(outer)
    missing = (F.floor((F.col(time) - F.col("after") - 1) / F.lit(interval_ms))).cast("bigint")
    return (steps.where(F.col(time) - F.col("after") > interval_ms)
            .select(key, F.col("after").alias("after_time"), F.col(time).alias("next_time"), missing.alias("missing")))


def frame_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with both counts: the difference of two bags in one shuffle."""
    columns = actual.columns
    tagged = (actual.select("*", F.lit(1).alias("__a"), F.lit(0).alias("__e"))
              .unionByName(expected.select(*columns, F.lit(0).alias("__a"), F.lit(1).alias("__e"))))
    return (tagged.groupBy(*columns).agg(F.sum("__a").alias("in_actual"), F.sum("__e").alias("in_expected"))
            .where("in_actual <> in_expected"))


def compare_cases(cases: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """One row per described case: how many distinct rows differ, and whether it agrees."""
    parts = [frame_diff(a, e).agg(F.count("*").alias("differences")).select(
        F.lit(text).alias("description"), "differences", (F.col("differences") == 0).alias("agrees"))
        for text, (a, e) in cases.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
