"""Exact classification metrics over a scored frame, for the whole table or per group.

Input columns: the truth ``y``, the predicted class ``y_pred`` and a probability: ``p`` of class 1 for two
classes, one column per class for more. ``by`` names the grouping columns; all groups share one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.operators.running import ROWS_PER_BUCKET, cut_points, running_totals
from wickline.session import settled

EPS = 2.220446049250313e-16  # fixed value: clipping bound of the log loss


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(0.0))


def pair_counts(df: DataFrame, by: Sequence[str] = (), y: str = "y", y_pred: str = "y_pred") -> DataFrame:
    """Rows per (group, truth, prediction): the only pass the label metrics make."""
    return df.groupBy(*by, F.col(y).alias("y"), F.col(y_pred).alias("y_pred")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, classes: Sequence | None = None, y: str = "y", y_pred: str = "y_pred") -> DataFrame:
    """Every pair of classes with its count, zeros kept; rows are the truth. Rows without a class are in no pair.

    The result has the square of the classes; where these are very many, ``pair_counts`` has only what occurs.
    """
    counts, kind = pair_counts(df, (), y, y_pred), df.schema[y].dataType.simpleString()
    if classes is None:
        counts = settled(counts, "pairs")
        found = counts.select(F.inline(F.array(F.struct("y"), F.struct(F.col("y_pred").alias("y"))))).where("y is not null").distinct()
    else:
        found = df.sparkSession.createDataFrame([(a,) for a in classes], f"y {kind}")
    # Each class takes the list of all of them, a single row.
    pairs = found.crossJoin(found.agg(F.collect_list("y").alias("all"))).select("y", F.explode("all").alias("y_pred"))
    return (pairs.join(counts, ["y", "y_pred"], "left")
            .select("y", "y_pred", F.coalesce("n", F.lit(0)).alias("n")))


def _per_class(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    hit = F.when(F.col("y") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = counts.select(*by, F.inline(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("y_pred").alias("class"), zero.alias("support"), F.col("n").alias("predicted"),
                 zero.alias("tp")))))
    sums = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    return sums.select(*by, "class",
                       _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
                       _ratio(F.col("tp"), F.col("support")).alias("recall"),
                       _ratio(F.col("tp") * 2.0, F.col("support") + F.col("predicted")).alias("f1"),
                       "support", "tp")


def per_class_report(df: DataFrame, by: Sequence[str] = (), y: str = "y", y_pred: str = "y_pred") -> DataFrame:
    """Precision, recall, F1 and support of each class; 0 where a denominator is 0."""
    return _per_class(pair_counts(df, by, y, y_pred), by).drop("tp")


def _label_summary(df: DataFrame, by: Sequence[str], y: str, y_pred: str) -> DataFrame:
    classes = _per_class(pair_counts(df, by, y, y_pred), by)
    weighted = [(F.sum(F.col("support") * F.col(m)) / F.sum("support")).alias(m) for m in ("precision", "recall", "f1")]
    macro = [F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")]
    return classes.groupBy(*by).agg(
        *weighted, *macro, (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.sum("support").alias("support"))


def weighted_prf(df: DataFrame, by: Sequence[str] = (), y: str = "y", y_pred: str = "y_pred") -> DataFrame:
    """Support-weighted means of the class metrics."""
    return _label_summary(df, by, y, y_pred).select(*by, "precision", "recall", "f1")


def accuracy(df: DataFrame, by: Sequence[str] = (), y: str = "y", y_pred: str = "y_pred") -> DataFrame:
    """Accuracy, and the mean recall of the classes that occur."""
    return _label_summary(df, by, y, y_pred).select(*by, "accuracy", "balanced_accuracy")


def classification_report(df: DataFrame, y: str = "y", y_pred: str = "y_pred") -> DataFrame:
    """Class rows, then the accuracy, macro-average and weighted-average rows."""
    classes = _per_class(pair_counts(df, (), y, y_pred), ())
    shown = classes.select(F.col("class").cast("string").alias("label"), "precision", "recall", "f1", "support")
    s = _label_summary(df, (), y, y_pred)
    totals = s.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), *[F.col("accuracy").alias(m) for m in ("precision", "recall", "f1")],
                 "support"),
        F.struct(F.lit("macro avg").alias("label"), *[F.col(f"macro_{m}").alias(m) for m in ("precision", "recall", "f1")],
                 "support"),
        F.struct(F.lit("weighted avg").alias("label"), "precision", "recall", "f1", "support"))))
    return shown.unionByName(totals)


def _clipped(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(EPS)), F.lit(1.0 - EPS))


def log_loss_of(y: Column, p: Column) -> Column:
    """Loss of one row of a two-class frame."""
    return -F.ln(_clipped(F.when(y == 1, p).otherwise(F.lit(1.0) - p)))


def log_loss(df: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p",
             class_p: dict | None = None) -> DataFrame:
    """Mean negative log probability of the truth. ``class_p`` maps each class to its column."""
    if class_p is None:
        row = log_loss_of(F.col(y), F.col(p))
    else:
        row = -F.ln(_clipped(F.coalesce(*[F.when(F.col(y) == k, F.col(c)) for k, c in class_p.items()])))
    return df.groupBy(*by).agg(F.avg(row).alias("log_loss"))


def brier_score(df: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p",
                class_p: dict | None = None) -> DataFrame:
    """Mean squared error of the probability; over more classes the mean of one-against-rest scores."""
    pairs = {1: p} if class_p is None else class_p
    squares = [F.pow(F.col(c) - (F.col(y) == k).cast("double"), F.lit(2.0)) for k, c in pairs.items()]
    return df.groupBy(*by).agg((sum(F.avg(s) for s in squares) / F.lit(float(len(squares)))).alias("brier_score"))


def score_marks(df: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """Each row as a score with one positive or one negative."""
    positive = (F.col(y) == 1).cast("bigint")
    return df.select(*by, F.col(p).alias("score"), positive.alias("pos"), (F.lit(1) - positive).alias("neg"))


def cumulative_counts(df: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p",
                      cuts: Sequence[float] = ()) -> DataFrame:
    """Per distinct score: positives and negatives at it (pos, neg) and at or above it (tp, fp)."""
    marks = score_marks(df, by, y, p)
    counts = marks.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return running_totals(counts, "score", {"tp": "pos", "fp": "neg"}, by, cuts, descending=True, base=marks)


def one_vs_rest(df: DataFrame, class_p: dict, by: Sequence[str] = (), y: str = "y") -> DataFrame:
    """A row per class: is it the truth, and what probability it got."""
    parts = [F.struct(F.lit(k).alias("class"), (F.col(y) == k).cast("int").alias("y"), F.col(c).alias("p"))
             for k, c in class_p.items()]
    return df.select(*by, F.inline(F.array(*parts)))


def ranking_metrics(df: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p",
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Area under the ROC curve (ties count half) and step-wise average precision.

    NULL where a group has only one class.
    """
    cuts = cut_points(df, p, rows_per_bucket)
    down = cumulative_counts(df, by, y, p, cuts)
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    # each negative is beaten by the positives with a higher score, and half-beaten by those tied with it
    beaten = F.sum(neg * (tp - pos / 2.0))
    sums = down.groupBy(*by).agg(F.sum(pos).alias("P"), F.sum(neg).alias("N"), beaten.alias("beaten"),
                                 F.sum(pos * tp / (tp + fp)).alias("steps"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return sums.select(*by, F.when(both, F.col("beaten") / (F.col("P") * F.col("N"))).alias("roc_auc"),
                       F.when(F.col("P") > 0, F.col("steps") / F.col("P")).alias("average_precision"))


def roc_auc(df: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p",
            class_p: dict | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Two classes: the area. More: the unweighted mean of the one-against-rest areas."""
    return _macro("roc_auc", df, by, y, p, class_p, rows_per_bucket)


def average_precision(df: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p",
                      class_p: dict | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    return _macro("average_precision", df, by, y, p, class_p, rows_per_bucket)


def _macro(metric: str, df, by, y, p, class_p, rows_per_bucket) -> DataFrame:
    if class_p is None:
        return ranking_metrics(df, by, y, p, rows_per_bucket).select(*by, metric)
    long = one_vs_rest(df, class_p, by, y)
    per_class = ranking_metrics(long, [*by, "class"], rows_per_bucket=rows_per_bucket)
    return per_class.groupBy(*by).agg(F.avg(metric).alias(metric))


OVERALL = ["loss", "precision", "recall", "f1", "accuracy", "balanced_accuracy", "roc_auc",
           "precision_recall_auc", "brier_score"]


def overall_metrics(df: DataFrame, by: Sequence[str] = (), prefix: str = "", class_p: dict | None = None,
                    y: str = "y", y_pred: str = "y_pred", p: str = "p",
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The nine metrics as one wide row per group, names prefixed (``holdout_loss`` and so on)."""
    keys = list(by) or ["__one"]
    frame = df if by else df.withColumn("__one", F.lit(1))
    labels = _label_summary(frame, keys, y, y_pred)
    loss = log_loss(frame, keys, y, p, class_p).withColumnRenamed("log_loss", "loss")
    brier = brier_score(frame, keys, y, p, class_p)
    if class_p is None:
        ranks = ranking_metrics(frame, keys, y, p, rows_per_bucket)
    else:
        ranks = ranking_metrics(one_vs_rest(frame, class_p, keys, y), [*keys, "class"], rows_per_bucket=rows_per_bucket)
        ranks = ranks.groupBy(*keys).agg(F.avg("roc_auc").alias("roc_auc"),
                                         F.avg("average_precision").alias("average_precision"))
    wide = labels
    for part in (loss, brier, ranks.withColumnRenamed("average_precision", "precision_recall_auc")):
        wide = _join_groups(wide, part, keys)
    lead = f"{prefix}_" if prefix else ""
    return wide.select(*by, *[F.col(m).alias(f"{lead}{m}") for m in OVERALL])


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on group columns where null is a group like any other."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"__right_{k}" for k in keys])


def as_metric_rows(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Wide metric columns as (name, value) rows."""
    names = [c for c in wide.columns if c not in by]
    return wide.unpivot(list(by), names, "name", "value")


def evaluate_scored(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Brier score and ROC area of a scored set."""
    one = df.withColumn("__one", F.lit(1))
    return (brier_score(one, ["__one"], y, p).join(roc_auc(one, ["__one"], y, p), "__one")
            .select(F.col("brier_score").alias("brier"), F.col("roc_auc").alias("roc")))
