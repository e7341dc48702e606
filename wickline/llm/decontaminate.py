"""Benchmark passages in documents: SimHash of item-sized windows, a multi-index Hamming join, exact similarity.

A window has as many words as the item and is described by the multiset of its five-word shingles. Fingerprints
have 64 bits. Two of them within a distance of 19 agree in one of four 16-bit blocks but for at most four
bits (pigeonhole: 4 blocks x 5 errors = 20), so the item's blocks with every such error are looked up by the window's
blocks. Windows at the least similarity of 0.8 lie 9.7 bits apart on average, with a deviation of 2.9. Only
DataFrame functions.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.spans import SHINGLE
from wickline.session import settled

BLOCKS, BLOCK_BITS, ERRORS = 4, 16, 4
#: Shingles of items, and rows that hold one, are broadcast up to so many (16 bytes each), else joined by a shuffle.
MOST_BROADCAST = 500_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: Column, length: int) -> Column:
    """Hashes of each ``length`` words in a row; empty for fewer words."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(w) - length), lambda i: F.xxhash64(F.lit(length), *[F.get(w, i + k) for k in range(length)]))
    return F.when(F.size(w) >= length, grams).otherwise(F.array().cast("array<bigint>"))


def fingerprint(hashes: Column) -> Column:
    """Bit b is set when more than half of the shingles, each as often as it occurs, have it.

    Four counters of 16 bits share a long, so 16 sums give all 64 counts.
    """
    lanes = F.lit(0x0001000100010001)
    total, out = F.size(hashes).cast("long"), F.lit(0).cast("long")

    def counter(shift: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: a + F.shiftrightunsigned(x, shift).bitwiseAND(lanes))

    for i in range(16):
        counts = counter(i)
        for lane in range(4):
            count = F.shiftrightunsigned(counts, 16 * lane).bitwiseAND(F.lit(0xFFFF))
            out = out.bitwiseOR(F.shiftleft((count * 2 > total).cast("long"), i + 16 * lane))
    return out


def _block() -> Column:
    return F.expr(f"cast(shiftrightunsigned(fp, cast(block * {BLOCK_BITS} as int)) & 65535 as int)")


def _common(a: Column, b: Column) -> Column:
    """Size of the intersection of two multisets."""
    times = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    return F.aggregate(F.array_distinct(b), F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def leaks(docs: DataFrame, items: DataFrame, least: float = 0.8, short: bool = False) -> DataFrame:
    """doc_id, item_id, similarity and first_word of the best window of each document and benchmark item.

    ``docs`` has doc_id and text, ``items`` item_id and text. A row appears where a window of the item's number of
    words reaches ``least`` (0.8 or more) in weighted Jaccard similarity of shingles; of equal windows the
    first counts. Items of fewer than five words are one shingle, those without words match nothing; null texts
    are empty. Repeated rows give one row; ids may be null; other columns are ignored; empty tables give an
    empty result. With ``short`` a text of fewer shingles than the item is one window as well, that of all its words.

    A window gets a fingerprint only if enough of its shingles occur in items of its size to reach ``least``.
    All pairs that are looked up are decided by their exact similarity. What is broadcast is counted first.
    """
    items = items.select("item_id", words(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") > 0).distinct()
    sized = items.withColumn("length", F.least(F.size("w"), F.lit(SHINGLE)))
    hashes = F.coalesce(*[F.when(F.col("length") == n, shingles(F.col("w"), n)) for n in range(1, SHINGLE + 1)])
    known = settled(sized.select("item_id", "length", hashes.alias("h")).withColumn("m", F.size("h")), "items")
    wanted = settled(known.select("length", "m", F.explode("h").alias("h")).distinct(), "item-shingles")
    lengths = sorted(r.length for r in known.select("length").distinct().collect())  # at most five
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("row_a"), F.xxhash64(F.lit(7), "text", "doc_id").alias("row_b"), "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grams = lambda d: d.select("row_a", "row_b", "doc_id", words(F.col("text")).alias("w")).select(
        "row_a", "row_b", "doc_id", F.explode(F.array(*[
            F.struct(F.lit(n).alias("length"), shingles(F.col("w"), n).alias("h")) for n in lengths])).alias("g")).select(
        "row_a", "row_b", "doc_id", "g.length", "g.h")
    if not lengths:
        return rows.join(known, F.lit(False)).select("doc_id", "item_id", F.lit(1.0).alias("similarity"), F.lit(0).alias("first_word"))
    places = grams(rows).select("row_a", "row_b", "length", F.size("h").alias("n"), F.posexplode("h").alias("pos", "h"))
    hits = settled(places.join(_small(wanted), ["length", "h"]).select("row_a", "row_b", "length", "n", "m", "pos"), "hits")

    # All windows of an item's size that hold enough such shingles, as starts for each row and size: of two multisets
    # of ``size`` and m shingles that reach ``least``, least / (1 + least) x (size + m) are common.
    size, inside = F.least("m", "n"), F.col("start") + F.col("m") <= F.col("n")
    if short:
        inside |= (F.col("start") == 0) & (F.col("n") < F.col("m")) & (F.col("n") >= least * F.col("m") - 1e-6)
    starts = hits.select("row_a", "row_b", "length", "n", "m", F.explode(
        F.sequence(F.greatest(F.col("pos") - F.col("m") + 1, F.lit(0)), F.col("pos"))).alias("start")).where(
        inside).groupBy(
        "row_a", "row_b", "length", "n", "m", "start").agg(F.count("*").alias("held")).where(
        (1 + least) * F.col("held") >= least * (F.col("m") + size) - 1e-6)
    asked = starts.groupBy("row_a", "row_b", "length", "m").agg(F.collect_list("start").alias("starts"))
    marked = grams(rows.join(_small(hits.select("row_a", "row_b").distinct()), ["row_a", "row_b"], "left_semi"))
    windows = marked.dropDuplicates(["row_a", "row_b", "length"]).join(asked, ["row_a", "row_b", "length"])
    cut = windows.select("row_a", "row_b", "doc_id", "length", "m", F.explode(F.transform(
        "starts", lambda s: F.struct(s.alias("start"), F.slice("h", s + 1, F.col("m")).alias("h")))).alias("x"))
    printed = settled(cut.select("row_a", "row_b", "doc_id", "length", "m", "x.start", "x.h", fingerprint(F.col("x.h")).alias("fp")), "windows")

    blocks = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    masks = [sum(1 << b for b in bits) for e in range(ERRORS + 1) for bits in combinations(range(BLOCK_BITS), e)]
    errors = docs.sparkSession.createDataFrame([(x,) for x in masks], "mask int")
    key = _block()
    looked_up = known.withColumn("fp", fingerprint(F.col("h"))).select("item_id", "length", "m", "fp", blocks).select(
        "item_id", "length", "m", "block", key.alias("k")).join(F.broadcast(errors)).select(
        "item_id", "length", "m", "block", F.col("k").bitwiseXOR(F.col("mask")).alias("k"))
    own = ["row_a", "row_b", "doc_id", "length", "m", "start", "fp"]
    near = printed.select(*own, blocks).withColumn("k", key).join(looked_up, ["length", "m", "block", "k"]).select(
        "row_a", "row_b", "length", "m", "start", "item_id").distinct()
    pairs = near.join(printed.select("row_a", "row_b", "doc_id", "length", "m", "start", "h"), ["row_a", "row_b", "length", "m", "start"]).join(
        known.select(F.col("item_id"), "length", "m", F.col("h").alias("item_h")), ["item_id", "length", "m"])
    both = _common(F.col("h"), F.col("item_h"))
    scored = pairs.withColumn("common", both).withColumn("similarity", F.col("common") / (F.size("h") + F.col("m") - F.col("common")))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before")))
    return scored.where(F.col("similarity") >= least).groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.round("b.similarity", 6).alias("similarity"), (-F.col("b.before")).cast("int").alias("first_word"))
