"""Passages of many words that occur more than once, found by word windows with content-chosen anchors.

1. Every window of ``least`` words has one anchor: the GRAM words inside it with the least hash, the first of equals.
   Neighbouring windows with one anchor make a context, so a row stands for about fifteen words.
2. Contexts with equal bytes are counted; if there are several, all their windows repeat.
3. Of contexts that share their anchor with a different one, one of each kind is looked at again: the bytes of each of
   its windows are hashed and counted. Equal windows have equal anchors, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.spans import chunks, discard, mix, sliding_least, span_hashes, texts_of, word_spans
from wickline.session import settled

#: Words of an anchor. The first and last word of a window are not in it, as marks around a passage stick to them.
GRAM = 20
#: Words whose windows are looked at together; ``sliding_least`` takes up to two million.
STEP = 1 << 20
#: Windows that a worker holds before it hands them on.
MOST_HELD = 1 << 16
MARKS = np.zeros(256, dtype=bool)
MARKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _contexts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Anchor and hash of the whole, row, first window, number of windows and bytes of each context."""
    for batch in batches:
        out = []
        for row, held in chunks(texts_of(batch.column(2))):
            sums, start, end, first = word_spans(held)
            owner = np.repeat(np.arange(len(held)), np.diff(first))
            edges = np.cumsum([0, *(len(t) + 1 for t in held)])
            for a in range(0, len(start), STEP):
                b = min(a + STEP + least - 1, len(start))
                windows = np.arange(a, b - least + 1)
                windows = windows[windows + least <= first[owner[windows] + 1]]
                if not len(windows):
                    continue
                values = span_hashes(sums, start[a: b - GRAM + 1], end[a + GRAM - 1: b])
                anchor = a + sliding_least(values, least - GRAM - 1)[windows - a + 1]
                new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)])
                begin, count = windows[new], np.diff(np.r_[new, len(windows)])
                left, right, edge = start[begin], end[begin + count + least - 2], edges[owner[begin]]
                whole = mix(span_hashes(sums, left, right) + ((anchor[new] - begin) * 1000 + count).astype(np.uint64))
                out.append((values[anchor[new] - a], whole, row + owner[begin], begin - first[owner[begin]], count, left - edge, right - edge))
        if out:
            gram, whole, owner, at, count, left, right = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), batch.column(0).take(pa.array(owner)),
                 batch.column(1).take(pa.array(owner)), pa.array(at), pa.array(count.astype(np.int16)), pa.array(left), pa.array(right)],
                names=["gram", "whole", "row_a", "row_b", "at", "count", "begin", "end"])


def _window_rows(batch: pa.RecordBatch, out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    owner, gram, window, begin, end = (np.concatenate(c) for c in zip(*out))
    owner = pa.array(owner, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(gram), pa.array(window), pa.array(end - begin), batch.column("row_a").take(owner), batch.column("row_b").take(owner),
         pa.array(begin), pa.array(end)], names=["gram", "window", "size", "row_a", "row_b", "begin", "end"])


def _windows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """A hash of each asked window's bytes, with and without the marks before its first and after its last word."""
    for batch in batches:
        out, size = [], 0
        asked = batch.column("asked")
        bounds = np.r_[0, np.cumsum(asked.value_lengths().to_numpy())]
        grams, ats, counts = (x.to_numpy().astype(np.int64) for x in asked.flatten().flatten())
        for i, text in enumerate(texts_of(batch.column("text"))):
            sums, start, end, _ = word_spans([text])
            buffer = np.frombuffer(text, dtype=np.uint8)
            plain = np.where(MARKS[buffer], -1, np.arange(len(buffer)))
            before = np.maximum.accumulate(plain)
            after = np.minimum.accumulate(np.where(plain < 0, len(buffer), plain)[::-1])[::-1]
            inner, outer = after[start], before[end - 1] + 1
            only_marks = inner >= end
            inner, outer = np.where(only_marks, start, inner), np.where(only_marks, end, outer)
            at, count = ats[bounds[i]: bounds[i + 1]], counts[bounds[i]: bounds[i + 1]]
            gram = np.repeat(grams[bounds[i]: bounds[i + 1]], count)
            first = np.repeat(at - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            last = first + least - 1
            for left, cut_left in ((start, False), (inner, True)):
                for right, cut_right in ((end, False), (outer, True)):
                    own = np.ones(len(first), dtype=bool)
                    own &= (inner != start)[first] if cut_left else True
                    own &= (outer != end)[last] if cut_right else True
                    a, b = left[first[own]], right[last[own]]
                    out.append((np.full(len(a), i), gram[own], span_hashes(sums, a, b).view(np.int64), a, b))
                    size += len(a)
            if size > MOST_HELD:
                yield _window_rows(batch, out)
                out, size = [], 0
        if out:
            yield _window_rows(batch, out)


def repeated_passages(texts: DataFrame, least: int) -> DataFrame:
    """row_a, row_b, begin and end of the byte spans of ``texts`` (row_a, row_b, text) that belong to a repeated passage.

    A passage has ``least`` words or more between ASCII white space, is the same bytes at another place of any row,
    the same row included, and may leave out the marks (ASCII punctuation) that stick to its first and last word.
    """
    if least < GRAM + 2:
        raise ValueError(f"a passage must have at least {GRAM + 2} words")
    spark = texts.sparkSession
    found = settled(texts.select("row_a", "row_b", "text").mapInArrow(
        partial(_contexts, least=least),
        "gram long, whole long, row_a long, row_b long, at long, count short, begin long, end long"), "word-contexts")
    # Written first, so that the joins below shuffle both sides and can split a very common passage.
    shared = settled(found.groupBy("gram").agg(
        F.count("*").alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high")).where("n > 1").select(
        "gram", (F.col("low") != F.col("high")).alias("mixed")), "word-anchors")
    rows = settled(found.join(shared, "gram"), "word-shared")
    discard(spark, found, shared)
    several = settled(rows.groupBy("gram", "whole").agg(F.count("*").alias("n")).where("n > 1").select("gram", "whole"), "word-several")
    copies = rows.join(several, ["gram", "whole"]).select("row_a", "row_b", "begin", "end")
    # One context of each kind is enough: others of its kind are copies.
    asked = settled(rows.where("mixed").groupBy("gram", "whole").agg(
        F.min(F.struct("row_a", "row_b", "at", "count")).alias("one")).select("gram", "one.*").groupBy("row_a", "row_b").agg(
        F.collect_list(F.struct("gram", "at", "count")).alias("asked")), "word-asked")
    windows = settled(texts.select("row_a", "row_b", "text").join(asked, ["row_a", "row_b"]).mapInArrow(
        partial(_windows, least=least),
        "gram long, window long, size long, row_a long, row_b long, begin long, end long"), "word-windows")
    name = ["gram", "window", "size"]
    twice = settled(windows.groupBy(*name).agg(F.count("*").alias("n")).where("n > 1").select(*name), "word-twice")
    spans = settled(copies.union(windows.join(twice, name).select("row_a", "row_b", "begin", "end")), "word-spans")
    discard(spark, rows, several, asked, windows, twice)
    return spans
