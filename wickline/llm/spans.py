"""Hashes of byte spans, words and word shingles for whole Arrow batches at once, and other shared helpers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
PRIME, PRIME_BASE = (1 << 31) - 1, 1_103_515_245
#: Bytes of text that a worker hashes at once; each array of that takes 8 times as much, and a dozen live together.
CHUNK = 1 << 18
SHINGLE = 5
LOW_BITS = np.uint64((1 << 21) - 1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_tables: dict[str, np.ndarray] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, as a single document may have many megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables made by ``settled`` that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for frame in frames for f in frame.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def powers(n: int) -> tuple[np.ndarray, ...]:
    """BASE^i and BASE^-i modulo 2^64, and the same of PRIME_BASE modulo PRIME, for i below ``n``."""
    if len(_tables.get("up", ())) < n:
        size = max(n, CHUNK + 4096)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps)
        for name, base in (("prime_up", PRIME_BASE), ("prime_down", pow(PRIME_BASE, -1, PRIME))):
            steps = np.ones(1, dtype=np.uint64)
            while len(steps) < size:  # doubled, as a running product would overflow
                steps = np.concatenate([steps, steps * np.uint64(pow(base, len(steps), PRIME)) % np.uint64(PRIME)])
            _tables[name] = steps[:size]
    return tuple(_tables[name][:n] for name in ("up", "down", "prime_up", "prime_down"))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def prefix_sums(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of two polynomials over the bytes: modulo 2^64, and modulo a prime.

    The first alone is the same for known texts, as Thue-Morse words and their complements; the second is not.
    """
    up, _, prime_up, _ = powers(len(buffer))
    sums, others = (np.zeros(len(buffer) + 1, dtype=np.uint64) for _ in range(2))
    value = buffer.astype(np.uint64) + np.uint64(1)
    np.cumsum(value * up, out=sums[1:])
    np.cumsum(value * prime_up % np.uint64(PRIME), out=others[1:])  # below 2^64 for texts up to 8 GB
    return sums, others


def span_hashes(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span [start, end) that depends on its bytes alone."""
    _, down, _, prime_down = powers(len(sums[0]))
    other = (sums[1][end] - sums[1][start]) % np.uint64(PRIME) * prime_down[start] % np.uint64(PRIME)
    return mix((sums[0][end] - sums[0][start]) * down[start] ^ mix(other))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values: where the least one is, the first of equals in their upper 43 bits."""
    marked = (values & ~LOW_BITS) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        marked = np.minimum(marked[:-span], marked[span:])
        span *= 2
    if span < width:
        marked = np.minimum(marked[: len(marked) - (width - span)], marked[width - span:])
    return (marked & LOW_BITS).astype(np.int64)


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive documents of about CHUNK bytes together: index of the first one, documents."""
    first, size, held = 0, 0, []
    for i, text in enumerate(texts):
        if held and size + len(text) > CHUNK:
            yield first, held
            first, size, held = i, 0, []
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


def word_spans(texts: list[bytes], is_space: np.ndarray = SPACE) -> tuple:
    """Prefix sums over all texts, begin and end of their words in order, and where each text's words begin."""
    buffer = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = is_space[buffer]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    edges = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=edges[1:])
    return prefix_sums(buffer), start, end, np.searchsorted(start, edges)


def word_hashes(texts: list[bytes], is_space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (one more entry than texts)."""
    sums, start, end, first = word_spans(texts, is_space)
    return span_hashes(sums, start, end), first


def shingle_hashes(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's five-word shingles, as ``word_hashes`` gives them; fewer words make one shingle."""
    counts = np.diff(first)
    made = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    begins = np.zeros(len(made) + 1, dtype=np.int64)
    np.cumsum(made, out=begins[1:])
    # Where each shingle starts among the words, and how many words it has.
    at = np.arange(begins[-1]) + np.repeat(first[:-1] - begins[:-1], made)
    length = np.repeat(np.minimum(counts, SHINGLE), made)
    h = length.astype(np.uint64)
    for k in range(SHINGLE):
        inside = k < length
        word = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else h
        h = np.where(inside, mix(h * np.uint64(BASE) + word), h)
    return h, begins


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text: words between ASCII white space, A-Z in lower case."""
    for _, held in chunks(texts):
        words, first = word_hashes([t.lower() for t in held])
        shingles, begins = shingle_hashes(words, first)
        for a, b in zip(begins[:-1], begins[1:]):
            yield np.unique(shingles[a:b])


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def groups_of(batches: Iterable[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``; each table holds all rows of its keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        changes = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            changes[1:] |= c[1:] != c[:-1]
        if held:
            last = [held[-1].column(k)[-1].as_py() for k in key]
            changes[0] = any(c[0] != x for c, x in zip(columns, last))
        cuts = np.flatnonzero(changes)
        if not len(cuts):
            held.append(batch)
            continue
        if held or cuts[-1]:
            yield pa.Table.from_batches([*held, batch.slice(0, cuts[-1])])
        held = [batch.slice(cuts[-1])]
    if held:
        yield pa.Table.from_batches(held)
