"""Metrics over segments and time, experiments, drift and retraining signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickline.functions.pvalues import normal_p
from wickline.operators.metrics import log_loss_of
from wickline.operators.running import exact_quantiles, with_bucket


def row_metrics(y: str = "y", y_pred: str = "y_pred", p: str = "p") -> list[Column]:
    """Metrics that are means over rows, so any grouping, rollup or window yields them in one pass."""
    return [F.count("*").alias("rows"),
            F.avg((F.col(y) == F.col(y_pred)).cast("double")).alias("accuracy"),
            F.avg(log_loss_of(F.col(y), F.col(p))).alias("log_loss"),
            F.avg(F.pow(F.col(p) - F.col(y), F.lit(2.0))).alias("brier_score")]


def segment_metrics(df: DataFrame, segments: Sequence[str], **names: str) -> DataFrame:
    """Metrics of each segment beside the whole, and the distance between them."""
    groups = df.groupBy(*segments).agg(*row_metrics(**names))
    y, y_pred = names.get("y", "y"), names.get("y_pred", "y_pred")
    whole = df.agg(F.avg((F.col(y) == F.col(y_pred)).cast("double"))).first()[0]
    overall = F.lit(whole).cast("double")
    return groups.withColumns({"overall_accuracy": overall, "gap": F.col("accuracy") - overall})


def segment_cube(df: DataFrame, segments: Sequence[str], **names: str) -> DataFrame:
    """Metrics of every combination of segment columns; NULL stands for all values."""
    return df.cube(*segments).agg(*row_metrics(**names), F.grouping_id().cast("int").alias("level"))


def segment_spread(df: DataFrame, segments: Sequence[str], **names: str) -> DataFrame:
    """How far apart the segments' metrics are."""
    per = df.groupBy(*segments).agg(*row_metrics(**names))
    return per.agg(*[(F.max(m) - F.min(m)).alias(f"{m}_spread") for m in ("accuracy", "log_loss", "brier_score")],
                   F.count("*").alias("segments"))


def monitor_windows(df: DataFrame, time: str = "ts", width: str = "1 day", slide: str | None = None,
                    by: Sequence[str] = (), **names: str) -> DataFrame:
    """Metrics per tumbling (or, with ``slide``, sliding) time window."""
    w = F.window(F.col(time), width, slide) if slide else F.window(F.col(time), width)
    return df.groupBy(w.alias("w"), *by).agg(*row_metrics(**names)).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "rows", "accuracy",
        "log_loss", "brier_score")


def monitor_rolling(windows: DataFrame, metric: str = "accuracy", length: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the last windows and change against the one before; the input has one row per window."""
    w = Window.partitionBy(*by).orderBy("window_start")
    return windows.select(*by, "window_start", metric,
                          F.avg(metric).over(w.rowsBetween(1 - length, 0)).alias("rolling_mean"),
                          (F.col(metric) - F.lag(metric).over(w)).alias("change"))


def ab_test(df: DataFrame, variant: str, converted: str, control: str = "A", treatment: str = "B") -> DataFrame:
    """Conversion rates, lift, the pooled two-proportion z and its two-sided ``p``, over one row per unit."""
    def of(name: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col(variant) == name, value)), F.lit(0))

    hit = F.col(converted).cast("bigint")
    one = df.agg(of(control, F.lit(1)).alias("n_a"), of(control, hit).alias("x_a"),
                 of(treatment, F.lit(1)).alias("n_b"), of(treatment, hit).alias("x_b"))
    rates = one.withColumns({"rate_a": F.try_divide("x_a", "n_a"), "rate_b": F.try_divide("x_b", "n_b"),
                             "__q": F.try_divide(F.col("x_a") + F.col("x_b"), F.col("n_a") + F.col("n_b"))})
    spread = F.sqrt(F.col("__q") * (F.lit(1.0) - F.col("__q"))
                    * (F.try_divide(F.lit(1.0), F.col("n_a")) + F.try_divide(F.lit(1.0), F.col("n_b"))))
    measured = rates.select("n_a", "x_a", "n_b", "x_b", "rate_a", "rate_b",
                            (F.col("rate_b") - F.col("rate_a")).alias("lift"),
                            F.try_divide(F.col("rate_b") - F.col("rate_a"), spread).alias("z"))
    return measured.withColumn("p", normal_p("z"))


def with_normal_p(df: DataFrame, z: str = "z") -> DataFrame:
    """Add the two-sided p-value of a z statistic."""
    return df.withColumn("p_value", normal_p(z))


def drift_windows(df: DataFrame, baseline: DataFrame, columns: Sequence[str], window: Column, limit: float = 3.0) -> DataFrame:
    """Mean shift of each column in each window against the baseline mean, in the window's deviations."""
    base = baseline.agg(*[F.avg(c).alias(c) for c in columns]).first()
    per = df.groupBy(window.alias("window_start")).agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    rows = per.select("window_start", F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"), F.lit(base[c]).alias("baseline"),
        F.try_divide(F.abs(F.col(f"m_{c}") - F.lit(base[c])), F.col(f"s_{c}")).alias("z")) for c in columns])))
    return rows.withColumn("drifted", F.coalesce(F.col("z") > F.lit(float(limit)), F.lit(False)))


def psi(df: DataFrame, baseline: DataFrame, column: str, window: Column, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Population stability index of each window against baseline quantile bins."""
    edges = exact_quantiles(baseline, [column], [i / bins for i in range(1, bins)]).first()
    cuts = sorted({edges[f"q{i}"] for i in range(bins - 1)})
    base_rows = with_bucket(baseline.select(column), column, cuts, "bin").groupBy("bin").agg(F.count("*").alias("n"))
    found = {r["bin"]: r["n"] for r in base_rows.collect()}  # one row per bin
    whole = sum(found.values())
    shares = [max(found.get(b, 0) / whole, floor) for b in range(len(cuts) + 1)]
    binned = with_bucket(df.select(window.alias("window_start"), column), column, cuts, "bin")
    wide = binned.groupBy("window_start").agg(
        F.count("*").alias("rows"), *[F.count_if(F.col("bin") == b).alias(f"b{b}") for b in range(len(shares))])
    terms = []
    for b, e in enumerate(shares):
        a = F.greatest(F.col(f"b{b}") / F.col("rows"), F.lit(floor))
        terms.append((a - F.lit(e)) * F.ln(a / F.lit(e)))
    return wide.select("window_start", "rows", sum(terms[1:], terms[0]).alias("psi"))


def retrain_trigger(performance: DataFrame, drift: DataFrame, metric: str = "accuracy", least: float = 0.8,
                    psi_limit: float = 0.2) -> DataFrame:
    """Windows that call for retraining: too weak a metric or too large a shift."""
    both = performance.select("window_start", metric).join(drift.select("window_start", "psi"), "window_start", "full")
    weak, moved = F.col(metric) < F.lit(least), F.col("psi") > F.lit(psi_limit)
    return both.select("window_start", metric, "psi", F.coalesce(weak, F.lit(False)).alias("weak"),
                       F.coalesce(moved, F.lit(False)).alias("drifted"),
                       (F.coalesce(weak, F.lit(False)) | F.coalesce(moved, F.lit(False))).alias("retrain"))
