"""Removal of long byte strings that occur more than once, by column-wise construction over many strings.

The method inserts one symbol of every document per round and keeps the order of the inserted suffixes (the
transform) and their common prefixes. Over whole documents it needs as many rounds over all data as the
longest document has bytes. Here each string is the surrounding of an anchor, so a round is short, their
number is bounded, and Spark deals the strings out:

1. Every window of ``width`` bytes has one anchor: the 100-byte string in it with the least hash, the first
   of equals. Equal windows have equal anchors at equal places. Neighbouring windows with one anchor make a
   context, a span of at most 2 x width - 100 bytes.
2. Contexts with equal bytes are counted; if there are several, all their windows repeat.
3. Other contexts that share their anchor's bytes with a different context are fetched and dealt out by
   anchor. The column-wise rounds run from the last column to the first, over the strings of many anchors at
   once, and a window repeats when it shares ``width`` bytes with its neighbour in the order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.passages import repeated_passages
from wickline.llm.spans import CHUNK, discard, groups_of, mix, prefix_sums, sliding_least, small_batches, span_hashes, texts_of
from wickline.session import settled

ANCHOR = 100
#: Strings of one anchor that one task sorts; the windows of a commoner anchor are counted one by one.
MOST_STRINGS = 20_000


def contexts(buffer: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Contexts of the windows that begin at ``starts`` (ascending): first window, windows, anchor, two hashes."""
    sums = prefix_sums(buffer)
    grams = np.arange(len(buffer) - ANCHOR + 1)
    values = span_hashes(sums, grams, grams + ANCHOR)
    anchor = sliding_least(values, width - ANCHOR + 1)[starts]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]
    first = starts[new]
    count = np.diff(np.r_[np.flatnonzero(new), len(starts)])
    anchor = anchor[new]
    whole = span_hashes(sums, first, first + count + width - 1)
    return first, count, anchor, values[anchor], mix(whole + ((anchor - first) * 1000 + count).astype(np.uint64))


def _scan(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The contexts of each row's text."""
    for batch in batches:
        out = []
        texts = texts_of(batch.column(2))
        held, owners, size = [], [], 0
        for row, text in enumerate(texts):
            for at in range(0, max(len(text) - width + 1, 0), CHUNK):
                piece = text[at: at + CHUNK + width - 1]
                if size and size + len(piece) > CHUNK:
                    out.append(_scan_pieces(held, owners, width))
                    held, owners, size = [], [], 0
                held.append(piece)
                owners.append((row, at))
                size += len(piece)
        if held:
            out.append(_scan_pieces(held, owners, width))
        if out:
            row, at, ahead, count, gram, whole = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), batch.column(0).take(pa.array(row)),
                 batch.column(1).take(pa.array(row)), pa.array(at), pa.array(ahead.astype(np.int16)),
                 pa.array(count.astype(np.int16))], names=["gram", "whole", "row_a", "row_b", "at", "ahead", "count"])


def _scan_pieces(held: list[bytes], owners: list[tuple[int, int]], width: int) -> tuple[np.ndarray, ...]:
    buffer = np.frombuffer(b"".join(held), dtype=np.uint8)
    edges = np.cumsum([0, *map(len, held)])
    starts = np.concatenate([np.arange(a, b - width + 1) for a, b in zip(edges[:-1], edges[1:])])
    first, count, anchor, gram, whole = contexts(buffer, starts, width)
    piece = np.searchsorted(edges, first, side="right") - 1
    row, base = np.array(owners, dtype=np.int64).T
    return row[piece], base[piece] + first - edges[piece], anchor - first, count, gram, whole


def _fetch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that are asked for, cut from their row's text."""
    for batch in batches:
        texts = texts_of(batch.column("text"))
        rows, found = [], []
        for i, (text, asked) in enumerate(zip(texts, batch.column("asked").to_pylist())):
            for x in asked:
                rows.append((i, *x.values()))
                found.append(text[x["at"]: x["at"] + x["count"] + width - 1])
        row, gram, at, ahead, count = zip(*rows) if rows else ((),) * 5
        owner = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int64()), batch.column("row_a").take(owner), batch.column("row_b").take(owner),
             pa.array(at, pa.int64()), pa.array(ahead, pa.int16()), pa.array(count, pa.int16()), pa.array(found, pa.binary())],
            names=["gram", "row_a", "row_b", "at", "ahead", "count", "bytes"])


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low + 1 .. high]) for each pair, with low < high."""
    span, out = high - low, values[high].copy()
    level, step = values, 1
    while True:
        fits = (span >= step) & (span < 2 * step)
        if fits.any():
            out[fits] = np.minimum(level[low[fits] + step], level[high[fits]])
        if not (span >= 2 * step).any():
            return out
        # level[i]: the least of the last ``step`` values up to i.
        further = level.copy()
        further[step:] = np.minimum(level[step:], level[:-step])
        level, step = further, step * 2


def repeated_windows(group: np.ndarray, texts: list[bytes], ahead: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """A row of flags for each string, by window: another string of its group has the same ``width`` bytes there.

    ``group`` is ascending. Strings of one group are aligned at their anchor, ``ahead`` bytes after their begin.
    """
    left, right = int(ahead.max()), int((np.array(list(map(len, texts))) - ahead).max())
    columns = np.full((left + right, len(texts)), 256, dtype=np.int16)
    for i, text in enumerate(texts):
        at = left - int(ahead[i])
        columns[at: at + len(text), i] = np.frombuffer(text, dtype=np.uint8)
    order = np.arange(len(texts))
    common = np.zeros(len(texts), dtype=np.int64)  # with the string before, in the order
    flags = np.zeros((len(texts), int(count.max())), dtype=bool)
    rank = np.searchsorted(group, group) * 512
    for c in range(left + right - 1, -1, -1):
        symbol = columns[c][order]
        key = rank[order] + symbol
        moved = np.argsort(key, kind="stable")
        same = np.r_[False, (key[moved][1:] == key[moved][:-1]) & (symbol[moved][1:] < 256)]
        fresh = np.zeros_like(common)
        at = np.flatnonzero(same)
        if len(at):
            fresh[at] = _range_least(common, moved[at - 1], moved[at]) + 1
        order, common = order[moved], fresh
        window = c - left + ahead[order]
        hit = (np.maximum(common, np.r_[common[1:], 0]) >= width) & (window >= 0) & (window < count[order])
        flags[order[hit], window[hit]] = True
    return flags


def _sort_strings(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in groups_of(batches, ["gram"]):
        gram = whole.column("gram").to_numpy()
        starts = np.r_[np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]), len(gram)]
        first = 0
        while first < len(starts) - 1:
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + MOST_STRINGS, side="right")) - 1)
            part = whole.slice(starts[first], starts[last] - starts[first])
            at, ahead, count = (part.column(x).to_numpy().astype(np.int64) for x in ("at", "ahead", "count"))
            flags = repeated_windows(part.column("gram").to_numpy(), part.column("bytes").to_pylist(), ahead, count, width)
            edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, begin = np.nonzero(edge == 1)
            _, end = np.nonzero(edge == -1)
            take = pa.array(row)
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_a").combine_chunks().take(take), part.column("row_b").combine_chunks().take(take),
                     pa.array(at[row] + begin), pa.array(at[row] + end + width - 1)], names=["row_a", "row_b", "begin", "end"])
            first = last


def merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.r_[True, begin[1:] > end[:-1]][:len(begin)]
    return list(zip(begin[new].tolist(), end[np.r_[new[1:], True][:len(end)]].tolist()))


def _without(text: bytes, cuts: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in cuts:
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    return b"".join(parts)


def _cut(batches: Iterator[pa.RecordBatch], whole_characters: bool, clean: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, removed, runs, cleaned = [], [], [], [], []
        spans = batch.column("spans")
        bounds = np.r_[0, np.cumsum(spans.value_lengths().fill_null(0).to_numpy())]
        begin, end, passage = (x.to_numpy(zero_copy_only=False) for x in spans.flatten().flatten())
        for i, text in enumerate(texts_of(batch.column("text"))):
            own = slice(bounds[i], bounds[i + 1])
            first, last, apart = begin[own], end[own], passage[own]
            # Passages count towards the columns of the strings only where nothing else has them.
            cuts = merged(first[~apart], last[~apart]) if clean else merged(first, last)
            if whole_characters:
                cuts = [c for c in (_inside(text, *x) for x in cuts) if c[0] < c[1]]
            kept.append(_without(text, cuts))
            if clean:
                every = (_inside(text, *x) for x in merged(first, last))
                cleaned.append(_without(text, [c for c in every if c[0] < c[1]]))
            sizes.append(len(text))
            removed.append(len(text) - len(kept[-1]))
            runs.append(len(cuts))
        columns = [batch.column(c) for c in batch.schema.names if c not in ("row_a", "row_b", "spans")]
        names = [c for c in batch.schema.names if c not in ("row_a", "row_b", "spans")]
        made = {"kept_bytes": pa.array(kept, pa.binary()), "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(runs, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
        if clean:
            made["clean"] = pa.array(cleaned, pa.binary())
        yield pa.RecordBatch.from_arrays([*columns, *made.values()], names=[*names, *made])


def _inside(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The span without parts of characters at its ends."""
    while a < b and a < len(text) and text[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def remove_repeats(docs: DataFrame, width: int = 400, whole_characters: bool = False, keep: bool = False, words: int | None = None,
                   clean_words: int | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of each row with kept_bytes, n_bytes, n_removed, n_spans and kept_sha256.

    A byte is removed when a string of ``width`` bytes (more than 100) that covers it also begins at another
    place of any row's text, the same row included; strings never cross rows. A null text is empty; texts below
    ``width`` stay whole; repeated rows repeat each other's text, and so lose it. Ids may be null or repeat; other
    columns are left out; an empty table gives an empty result. With ``whole_characters`` a character
    stays unless all its bytes are to go, so what is kept is UTF-8. With ``keep`` the result is ``docs``, all its
    columns, with what is kept as ``text`` and its length as ``n_chars`` where there is such a column. With ``words``
    the bytes of repeated passages of so many words or more are removed as well, however few bytes they have. With
    ``clean_words`` the other columns stay as they are, and ``clean`` has the bytes that such a removal, of whole characters, leaves.
    """
    if clean_words is not None and (keep or words is not None):
        raise ValueError("clean_words is a column beside the strings' own: it takes neither keep nor words")
    if not ANCHOR < width < 2000:
        raise ValueError(f"width must lie between {ANCHOR} and 2000")
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        F.xxhash64("doc_id", "text").alias("row_a"), F.xxhash64(F.lit(7), "text", "doc_id").alias("row_b"),
        F.struct(*([c for c in docs.columns if c != "text"] if keep else ["doc_id"])).alias("rest"),
        F.col("text").cast("string").alias("text"))
    found = settled(texts.select("row_a", "row_b", "text").mapInArrow(
        partial(_scan, width=width),
        "gram long, whole long, row_a long, row_b long, at long, ahead short, count short"), "contexts")
    # Written first, so that the join below shuffles both sides and can split a very common anchor.
    shared = settled(found.groupBy("gram").agg(
        F.count("*").alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high")).where("n > 1").select(
        "gram", (F.col("low") != F.col("high")).alias("mixed")), "anchors")
    rows = settled(found.join(shared, "gram"), "shared")
    discard(spark, found, shared)
    several = settled(rows.groupBy("gram", "whole").agg(F.count("*").alias("times")).where("times > 1").select("gram", "whole"), "several")
    span = [F.col("at").alias("begin"), (F.col("at") + F.col("count") + width - 1).alias("end")]
    copies = rows.join(several, ["gram", "whole"]).select("row_a", "row_b", *span)

    # One string of each kind is enough: others of its kind are copies.
    strings = settled(rows.where("mixed").groupBy("gram", "whole").agg(
        F.min(F.struct("row_a", "row_b", "at", "ahead", "count")).alias("one")).select("gram", "one.*"), "strings")
    common = settled(strings.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > MOST_STRINGS).select("gram"), "common")
    asked = strings.groupBy("row_a", "row_b").agg(
        F.collect_list(F.struct("gram", "at", "ahead", "count")).alias("asked"))
    cut = texts.join(asked, ["row_a", "row_b"]).mapInArrow(
        partial(_fetch, width=width), "gram long, row_a long, row_b long, at long, ahead short, count short, bytes binary")
    counted = not common.isEmpty()
    sorted_rows = cut.join(common, "gram", "left_anti") if counted else cut
    near = sorted_rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(
        partial(_sort_strings, width=width), "row_a long, row_b long, begin long, end long")
    repeats = copies.union(near)
    if counted:
        repeats = repeats.union(_window_counts(cut.join(common, "gram", "left_semi"), width))
    repeats = repeats.withColumn("passage", F.lit(False))
    if words is not None or clean_words is not None:
        repeats = repeats.union(repeated_passages(texts, words or clean_words).withColumn("passage", F.lit(True)))
    # As a set, as rows that are the same in all have each other's spans.
    spans = repeats.groupBy("row_a", "row_b").agg(F.collect_set(F.struct("begin", "end", "passage")).alias("spans"))
    out = texts.join(spans, ["row_a", "row_b"], "left").mapInArrow(
        partial(_cut, whole_characters=whole_characters, clean=clean_words is not None),
        f"rest {texts.schema['rest'].dataType.simpleString()}, text string, kept_bytes binary, n_bytes long, n_removed long, "
        "n_spans long, kept_sha256 string" + (", clean binary" if clean_words is not None else ""))
    if not keep:
        return out.select("rest.doc_id", *out.columns[1:])
    new = {c: F.col("rest").getField(c) for c in docs.columns if c != "text"}
    new["text"] = F.when(F.col("text").isNotNull(), F.decode("kept_bytes", "UTF-8"))
    if "n_chars" in new:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length(new["text"])).otherwise(new["n_chars"])
    return out.select(*[new[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def _window_counts(strings: DataFrame, width: int) -> DataFrame:
    """For anchors with more strings than a task should sort: every window's bytes hashed and counted."""
    windows = strings.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("count").cast("int") - 1))).select(
        "gram", "row_a", "row_b", (F.col("at") + F.col("k")).alias("begin"), (F.col("ahead") - F.col("k")).alias("j"),
        F.substring("bytes", F.col("k") + 1, F.lit(width)).alias("w")).select(
        "gram", "row_a", "row_b", "begin", "j", F.xxhash64("w").alias("w_a"), F.xxhash64(F.lit(7), "w").alias("w_b"))
    name = ["gram", "j", "w_a", "w_b"]
    twice = windows.groupBy(*name).agg(F.count("*").alias("n")).where("n > 1")
    return windows.join(twice, name).select("row_a", "row_b", "begin", (F.col("begin") + width).alias("end"))
