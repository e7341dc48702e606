"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are learned with follow-the-regularised-leader and elastic-net penalties, then the scores are
calibrated with one temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.spans import CHUNK, small_batches

BITS = 15
SIZE = 1 << BITS
#: About so many labelled rows are fitted on, shared out evenly among the languages; a fifth of them calibrates.
FIT_ROWS = 3000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.002, 0.001
UNKNOWN = "und"

_letter: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Code points in lower case, with a blank for everything but letters."""
    if not _letter:
        _letter.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    return np.where(_letter[0][codes], codes, np.uint32(32)).astype(np.uint64)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of one to three characters of a whole text, with their counts; none for a text without letters."""
    codes = letters(text)
    total = np.zeros(SIZE, dtype=np.int64)
    if not (codes != 32).any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    for at in range(0, len(codes), CHUNK):
        part = codes[at: at + CHUNK + 2]
        gram = part
        for n in range(3):
            if n:
                gram = gram[:-1] * np.uint64(1_000_003) + part[n:]
            own = gram[: min(CHUNK, len(gram))]
            hashed = ((own * np.uint64(3) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
            total += np.bincount(hashed.astype(np.int64), minlength=SIZE)
    found = np.flatnonzero(total)
    return found, total[found]


def weigh(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[found]
    return (x / max(np.sqrt(x @ x), 1e-12)).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # a row for each hashed n-gram, a column for each language
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        found, counts = gram_counts(text or "")
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0
        scores = (weigh(found, counts, self.idf) @ self.weights[found] + self.bias) / self.temperature
        p = softmax(scores.astype(np.float64))
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """FTRL-proximal steps with per-coordinate rates: weights below the first penalty stay at 0."""

    def __init__(self, rows: int, classes: int):
        self.z = np.zeros((rows, classes))
        self.n = np.zeros((rows, classes))

    def weights(self, rows) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def step(self, rows, w: np.ndarray, gradient: np.ndarray) -> None:
        grown = self.n[rows] + gradient * gradient
        self.z[rows] += gradient - (np.sqrt(grown) - np.sqrt(self.n[rows])) / ALPHA * w
        self.n[rows] = grown


def _fit(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    leader = Ftrl(SIZE + 1, classes)
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(examples)):
            found, x, y = examples[i]
            rows, x = np.r_[found, SIZE], np.r_[x, 1.0]
            w = leader.weights(rows)
            error = softmax(x @ w)
            error[y] -= 1
            leader.step(rows, w, x[:, None] * error)
    w = leader.weights(slice(None)).astype(np.float32)
    return w[:-1], w[-1]


def _temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The one that gives held-back rows the least log loss, by golden-section search over its logarithm."""
    def loss(log_t: float) -> float:
        return -np.log(np.maximum(softmax(scores / np.exp(log_t))[np.arange(len(y)), y], 1e-300)).mean()

    low, high, ratio = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of the task's texts hold each n-gram; the texts themselves at SIZE."""
    total = np.zeros(SIZE + 1, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found, _ = gram_counts(text or "")
            total[found] += 1
            total[SIZE] += bool(len(found))
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["gram", "n"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [gram_counts(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([f.astype(np.int32) for f, _ in rows], pa.list_(pa.int32())),
             pa.array([c.astype(np.int32) for _, c in rows], pa.list_(pa.int32()))], names=["lang", "back", "found", "counts"])


def fit(labelled: DataFrame, key: Column, fit_rows: int = FIT_ROWS) -> Model:
    """A model of ``text`` and ``lang``. Rows whose lang is null, and texts without a letter, teach nothing.

    Document frequencies come from all labelled rows. The weights come from about ``fit_rows`` of them (the
    documented bound), which a hash of ``key`` and text picks, the same number for each language; they are
    sent to the driver as sparse rows. Without any row the model predicts ``und``.
    """
    small_batches(labelled.sparkSession)
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(SIZE), np.zeros((SIZE, 0), np.float32), np.zeros(0), 1.0)
    seen = np.zeros(SIZE + 1)
    for r in labelled.select("text").mapInArrow(_frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        seen[r.gram] = r.n
    idf = np.log((1 + seen[SIZE]) / (1 + seen[:SIZE])) + 1
    shares = labelled.sparkSession.createDataFrame(
        [(lang, int(min(1.0, fit_rows / len(languages) / n) * 1e9)) for lang, n in sizes.items()], "lang string, share long")
    place = F.pmod(F.xxhash64(key, "text"), F.lit(1_000_000_000))
    picked = labelled.withColumn("place", place).join(shares, "lang").where("place < share").select(
        "lang", "text", (F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("back"))
    rows = picked.mapInArrow(_examples, "lang string, back boolean, found array<int>, counts array<int>").toArrow()
    number = {lang: i for i, lang in enumerate(languages)}
    taught, held = [], []
    for lang, back, found, counts in zip(*(rows.column(c) for c in ("lang", "back", "found", "counts"))):
        found, counts = found.values.to_numpy(), counts.values.to_numpy()
        if len(found):
            (held if back.as_py() else taught).append((found, weigh(found, counts, idf), number[lang.as_py()]))
    weights, bias = _fit(taught, len(languages))
    temperature = 1.0
    if held:
        scores = np.array([x @ weights[f] + bias for f, x, _ in held], dtype=np.float64)
        temperature = _temperature(scores, np.array([y for *_, y in held]))
    return Model(languages, idf, weights, bias, temperature)


def _predict(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        said = [model.predict(t) for t in batch.column("text").to_pylist()]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
            names=[*names, "lang_pred", "score"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` without ``text`` but with lang_pred and score, the calibrated probability.

    A text that is null or has no letter is ``und`` with score 0. Only the text counts. Names lang_pred and
    score in ``docs`` are not allowed. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(partial(_predict, shared=shared), ", ".join([*kept, "lang_pred string", "score double"]))
