"""Toxicity as grades of severity, by cumulative-link ordinal regression on sparse word features.

P(grade > g) = logistic(w x - t_g): all thresholds share the weights, and t_1 < t_2 < ... by construction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.spans import SPACE, chunks, discard, mix, shingle_hashes, small_batches, span_hashes, texts_of, word_spans
from wickline.session import settled

#: About so many labelled rows of either label are fitted on.
FIT_ROWS = 3000
#: Besides the whole word, its first bytes are features, as stems take many endings.
STEMS = (4, 5, 6)
#: A word or stem counts when it is so many times as common in toxic rows as in clean ones, and the likelihood ratio of
#: that is so large (20: a chance of one in 10^5).
LEAST_LIFT, LEAST_RATIO = 20.0, 20.0
STEPS, RATE, PENALTY = 600, 0.05, 1e-5

#: Words are runs of ASCII letters and digits and of other characters.
BETWEEN = SPACE.copy()
BETWEEN[[i for i in range(128) if not chr(i).isalnum()]] = True


@dataclass
class Model:
    words: np.ndarray  # ascending hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one below each grade but the lowest

    def grades(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the grades for each score w x."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - x[:, None], -500, 500)))
        edges = np.concatenate([np.ones((len(x), 1)), above, np.zeros((len(x), 1))], axis=1)
        return edges[:, :-1] - edges[:, 1:]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-case words and stems of all texts, their text's number; words and where each text's begin."""
    sums, start, end, first = word_spans([t.lower() for t in texts], BETWEEN)
    words = span_hashes(sums, start, end)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    made, owners = [words], [owner]
    for n in STEMS:
        longer = np.flatnonzero(end - start > n)
        made.append(mix(span_hashes(sums, start[longer], start[longer] + n) + np.uint64(n)))
        owners.append(owner[longer])
    return np.concatenate(made), np.concatenate(owners), words, first


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features with counts, and three least shingles, by which copies are told."""
    seeds = mix(np.arange(1, 4, dtype=np.uint64))
    for batch in batches:
        found, counts, least = [], [], []
        for _, held in chunks(texts_of(batch.column(1))):
            made, owner, words, first = features(held)
            shingles, begins = shingle_hashes(words, first)
            order = np.argsort(owner, kind="stable")
            made, cuts = made[order], np.searchsorted(owner[order], np.arange(len(held) + 1))
            for i in range(len(held)):
                names, times = np.unique(made[cuts[i]: cuts[i + 1]], return_counts=True)
                found.append(names.view(np.int64))
                counts.append(times.astype(np.int32))
                own = shingles[begins[i]: begins[i + 1]]
                least.append([int(mix(own ^ s).min().view(np.int64)) for s in seeds] if len(own) else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(2).cast(pa.int64()), batch.column(0), pa.array(found, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32())),
             pa.array(least, pa.list_(pa.int64()))], names=["doc_id", "toxic", "words", "counts", "least"])


def _apart(least: list[list[int]]) -> np.ndarray:
    """Rows that share none of their least shingles with an earlier row: copies would pass for evidence."""
    seen: set[tuple[int, int]] = set()
    keep = []
    for i, row in enumerate(least):
        marks = set(enumerate(row))
        if not marks & seen:
            keep.append(i)
        seen |= marks
    return np.array(keep, dtype=np.int64)


def _marked_words(pairs: DataFrame, clean_rows: int, toxic_rows: int) -> DataFrame:
    """Words that mark toxic rows. ``pairs`` has a row for each row and distinct word of it."""
    bad, n, share = F.col("bad"), F.col("n"), toxic_rows / max(clean_rows + toxic_rows, 1)
    log = lambda x, of: F.when(x > 0, x * F.log(x / (n * of))).otherwise(0.0)
    ratio = 2 * (log(bad, share) + log(n - bad, 1 - share))
    lift = bad / max(toxic_rows, 1) >= LEAST_LIFT * (n - bad) / max(clean_rows, 1)
    return pairs.groupBy("words").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).where(
        (bad > 0) & lift & (ratio >= LEAST_RATIO)).select("words")


def grades_from_flags(toxic: np.ndarray, marks: np.ndarray, grades: int) -> np.ndarray:
    """Severity where labels only say toxic or not: 0 for clean rows; toxic ones are graded from 1 by how
    many features they have that mark toxic rows, in about equal parts of the toxic rows."""
    cuts = np.quantile(marks[toxic], np.arange(1, grades - 1) / (grades - 1)) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(cuts, marks, side="right"), 0)


def fit_ordinal(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, columns: int, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the mean log loss of all rows, with a ridge on the weights.

    The thresholds are a first one and the logarithms of the steps between them.
    """
    p = np.concatenate([np.zeros(columns), np.arange(1, grades)[:1] * 0.0, np.zeros(grades - 2)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    n = len(grade)
    for t in range(1, STEPS + 1):
        w, first, steps = p[:columns], p[columns], np.exp(p[columns + 1:])
        cuts = first + np.r_[0.0, np.cumsum(steps)]
        score = np.bincount(row, weights=value * w[column], minlength=n)
        edge = np.r_[-np.inf, cuts, np.inf]
        upper = 1 / (1 + np.exp(np.clip(score - edge[grade + 1], -500, 500)))  # P(y <= grade)
        lower = 1 / (1 + np.exp(np.clip(score - edge[grade], -500, 500)))
        mass = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        d_score = (d_upper - d_lower) / n
        d_cuts = np.zeros(grades + 1)
        np.add.at(d_cuts, grade + 1, -d_upper / n)
        np.add.at(d_cuts, grade, d_lower / n)
        d_cuts = d_cuts[1:-1]
        tail = np.cumsum(d_cuts[::-1])[::-1]
        gradient = np.concatenate([
            np.bincount(column, weights=value * d_score[row], minlength=columns) + PENALTY * w, tail[:1], tail[1:] * steps])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        p = p - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return p[:columns], p[columns] + np.r_[0.0, np.cumsum(np.exp(p[columns + 1:]))]


def fit(docs: DataFrame, labels: DataFrame, grades: int = 4, fit_rows: int = FIT_ROWS) -> Model:
    """A model from texts (doc_id, text) and labels (doc_id, toxic 0 or 1).

    About ``fit_rows`` rows of either label are used (the documented bound), picked by a hash of doc_id; they are
    few, so their labels are broadcast and no text moves; only features that mark a label reach the driver. Null labels and ids teach nothing; of several labels of an id
    the worst counts. Without toxic or clean rows, or without words that tell them apart, everything is clean.
    """
    spark = docs.sparkSession
    small_batches(spark)
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, fit_rows / sizes.get(1, 1))).otherwise(min(1.0, fit_rows / sizes.get(0, 1)))
    picked = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_000)) < share * 1_000_000_000)
    rows = settled(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").select(
        "toxic", "text", "doc_id").mapInArrow(
        _examples, "doc_id long, toxic int, words array<long>, counts array<int>, least array<long>"), "examples")
    known = rows.select("doc_id", "toxic", "least").toArrow().sort_by("doc_id")
    known = known.take(pa.array(_apart(known.column("least").to_pylist())))
    ids, toxic = known.column("doc_id").to_numpy(), known.column("toxic").to_numpy().astype(bool)
    kept = rows.join(F.broadcast(spark.createDataFrame([(int(i),) for i in ids], "doc_id long")), "doc_id")
    pairs = kept.select("doc_id", "toxic", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("doc_id", "toxic", "x.*")
    chosen = np.sort(np.array([r.words for r in _marked_words(pairs, int((~toxic).sum()), int(toxic.sum())).collect()], dtype=np.int64).view(np.uint64))
    if not len(chosen):
        discard(spark, rows)
        return Model(np.empty(0, np.uint64), np.empty(0), np.full(grades - 1, 20.0) + np.arange(grades - 1))
    marks = spark.createDataFrame([(int(w),) for w in chosen.view(np.int64)], "words long")
    found = pairs.join(F.broadcast(marks), "words").select("doc_id", "words", "counts").toArrow()
    discard(spark, rows)
    row = np.searchsorted(ids, found.column("doc_id").to_numpy())
    column = np.searchsorted(chosen, found.column("words").to_numpy().view(np.uint64))
    counts = found.column("counts").to_numpy()
    grade = grades_from_flags(toxic, np.bincount(row, weights=counts, minlength=len(toxic)), grades)
    weights, thresholds = fit_ordinal(row, column, 1 + np.log(counts), grade, len(chosen), grades)
    return Model(chosen, weights, thresholds)


def _predict(batches: Iterator[pa.RecordBatch], shared, names: list[str]) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    ladder = np.arange(len(model.thresholds) + 1)
    for batch in batches:
        scores = []
        for _, held in chunks(texts_of(batch.column("text"))):
            made, owner, *_ = features(held)
            column = np.minimum(np.searchsorted(model.words, made), max(len(model.words) - 1, 0))
            at = np.flatnonzero(model.words[column] == made) if len(model.words) else np.empty(0, np.int64)
            owner, column = owner[at], column[at] if len(at) else at
            # A word counts with the logarithm of its number in the text.
            pair, times = np.unique(np.stack([owner, column]), axis=1, return_counts=True)
            scores.append(np.bincount(pair[0], weights=(1 + np.log(times)) * model.weights[pair[1]], minlength=len(held))
                          if len(at) else np.zeros(len(held)))
        p = model.grades(np.concatenate([np.empty(0), *scores]))
        made = [pa.array(p @ ladder), pa.array(p.argmax(axis=1).astype(np.int32), pa.int32()), pa.array(p[:, 0] < 0.5)]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *made], names=[*names, "expected_severity", "grade", "toxic"])


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` with expected_severity (the mean grade), grade (the likeliest) and toxic: whether
    grades above 0 are likelier than 0. Null and empty texts are scored as texts without known words. Columns of
    those names are replaced. An empty table gives an empty result."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("expected_severity", "grade", "toxic")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(partial(_predict, shared=shared, names=docs.columns), f"{kept}, expected_severity double, grade int, toxic boolean")
