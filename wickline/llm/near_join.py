"""Near-duplicate documents by b-bit MinHash signatures and a multi-index Hamming join.

A signature is 128 MinHash values of 16 bits. The first 35 are cut into 7 chunks of 5. Two signatures that differ
in at most 13 of these have a chunk that differs in at most one (pigeonhole: 7 chunks x 2 errors = 14), so of the
keys that leave out one value of one chunk they share at least one. Pairs at Jaccard 0.85 have no such chunk with a
chance of about 4 in a million. For a lower similarity there are as many chunks as that chance needs: 10 at 0.80.
All 128 values then tell which pairs are near enough to be compared, and every link is confirmed on the full
shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.components import components
from wickline.llm.spans import BASE, chunks, discard, groups_of, mix, shingle_hashes, shingle_sets, small_batches, texts_of, word_hashes
from wickline.session import settled

CHUNKS, WIDTH, VALUES = 7, 5, 128
INDEXED = CHUNKS * WIDTH
#: The least similarity in percent, and the chances that a pair at the wanted one has no common key or is too far apart.
LEAST_PERCENT, MOST_WITHOUT_KEY, MOST_APART = 80, 4e-6, 1.5e-6
#: Rounds in which documents are compared with the nearest one outside their component, before all pairs are.
NEAREST_ROUNDS = 2
#: Ids are broadcast up to so many (8 MB), else joined by a shuffle.
MOST_BROADCAST = 500_000
#: Rows of one key that one task compares with each other; larger groups are cut into blocks of this size.
BLOCK = 2000
#: Shingles (8 bytes each) that one task holds of either side when sets are compared.
BLOCK_SHINGLES = 1 << 20


def reach(percent: int) -> tuple[int, int]:
    """Chunks that are indexed for a similarity, and the values in which pairs that are compared differ at most.

    These are 7 and 40 from 85 on, 10 and 48 at 80.
    """
    same = min(percent, 85) / 100
    without = 1 - same ** WIDTH - WIDTH * same ** (WIDTH - 1) * (1 - same)
    n = next(n for n in range(CHUNKS, VALUES // WIDTH + 1) if without ** n <= MOST_WITHOUT_KEY)
    chances = [comb(VALUES, k) * (1 - same) ** k * same ** (VALUES - k) for k in range(VALUES + 1)]
    return n, next(k for k in range(VALUES) if sum(chances[k + 1:]) <= MOST_APART)


def signatures(shingles: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A row of values for each text, from the shingles of all; texts without shingles get a row without meaning."""
    seeds = mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    least = np.zeros((len(begins) - 1, VALUES), dtype=np.uint64)
    full = np.flatnonzero(np.diff(begins))
    if len(full):
        product = np.empty_like(shingles)
        for i, seed in enumerate(seeds):
            np.multiply(shingles, seed, out=product)
            least[full, i] = np.minimum.reduceat(product, begins[full])
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, one, two, signed = [], [], [], []
        for _, held in chunks(texts_of(batch.column(1))):
            shingles, begins = shingle_hashes(*word_hashes([t.lower() for t in held]))
            signed.extend(row.tobytes() for row in signatures(shingles, begins))
            for a, b in zip(begins[:-1], begins[1:]):
                s = np.unique(shingles[a:b])
                sizes.append(len(s))
                one.append(int(np.bitwise_xor.reduce(s)) if len(s) else 0)
                two.append(int(np.add.reduce(mix(s))) if len(s) else 0)
        wide = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (one, two)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), *wide, pa.array(signed, pa.binary())],
            names=["doc_id", "n_shingles", "set_a", "set_b", "signature"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.view(np.int64) for s in shingle_sets(texts_of(batch.column(1)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"])


def chunk_keys(signatures: np.ndarray, n: int = CHUNKS) -> np.ndarray:
    """The keys of each row that leave out one value of one of ``n`` chunks."""
    signatures = signatures[:, :n * WIDTH]
    keys = np.empty((len(signatures), n * WIDTH), dtype=np.uint64)
    wide = signatures.astype(np.uint64).reshape(-1, n, WIDTH)
    for left_out in range(WIDTH):
        rest = np.delete(wide, left_out, axis=2)
        packed = np.zeros(rest.shape[:2], dtype=np.uint64)
        for k in range(WIDTH - 1):
            packed = (packed << np.uint64(16)) | rest[:, :, k]
        names = np.arange(n, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(left_out + 1)
        keys[:, left_out::WIDTH] = mix(packed ^ mix(names * np.uint64(BASE)))
    return keys


def _keys(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(-1, VALUES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk_keys(rows, n).ravel().view(np.int64)),
                 pa.array(np.repeat(batch.column(0).to_numpy(), n * WIDTH))], names=["key", "rep"])


def _meetings(group: pa.Table, nearest: bool, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """An asking row, and the held ones of its key and cell that lie in other components and whose signatures and sizes
    are near, as places in ``group``, with their distances.

    With ``nearest`` each asking row meets its nearest one, else every pair meets once, at the first key that it shares.
    """
    n, furthest = reach(percent)
    key, cell = group.column("key").to_numpy(), group.column("cell").to_numpy()
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
    rep, comp, size = (group.column(c).to_numpy() for c in ("rep", "component", "n_shingles"))
    asks, apart_from_main = (group.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "apart_from_main"))
    rows = np.frombuffer(b"".join(group.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, VALUES)
    for a, b in zip(starts, [*starts[1:], len(key)]):
        asking, held = a + np.flatnonzero(asks[a:b]), a + np.flatnonzero(~asks[a:b])
        if not len(asking) or not len(held):
            continue
        against, keys = rows[held], None if nearest else chunk_keys(rows[held], n)
        for i in asking:
            fits = (comp[held] != comp[i]) & (100 * np.minimum(size[held], size[i]) >= percent * np.maximum(size[held], size[i]))
            if not nearest:  # Two rows that both ask meet twice.
                fits &= ~apart_from_main[held] | (rep[held] > rep[i])
            other = np.flatnonzero(fits)
            if not len(other):
                continue
            apart = (against[other] != rows[i]).sum(axis=1)
            if nearest:
                best = int(apart.argmin())
                other, apart = other[best: best + 1], apart[best: best + 1]
            other, apart = other[apart <= furthest], apart[apart <= furthest]
            if not nearest and len(other):
                own = chunk_keys(rows[i: i + 1], n)[0]
                first = own[(keys[other] == own).argmax(axis=1)].view(np.int64) == key[i]
                other, apart = other[first], apart[first]
            if len(other):
                yield i, held[other], apart


def _nearest(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Each asking row with its nearest one."""
    for group in groups_of(batches, ["key", "cell"]):
        rep = group.column("rep").to_numpy()
        found = [(rep[i], rep[other[0]], apart[0]) for i, other, apart in _meetings(group, True, percent)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b", "apart"])


def _meeting(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows that meet another one in their key and cell, as they are."""
    for group in groups_of(batches, ["key", "cell"]):
        meets = np.zeros(group.num_rows, dtype=bool)
        for i, other, _ in _meetings(group, False, percent):
            meets[i] = meets[other] = True
        yield from group.filter(pa.array(meets)).combine_chunks().to_batches()


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The links among the rows of each key and cell, decided on their full sets."""
    for group in groups_of(batches, ["key", "cell"]):
        sets = group.column("shingles").combine_chunks()
        ends = np.asarray(sets.offsets) - sets.offsets[0].as_py()
        # The sets as small numbers, so that a set is marked in a table and all others are counted against it.
        shared, flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        marked = np.zeros(len(shared), dtype=bool)
        rep, found = group.column("rep").to_numpy(), []
        for i, others, _ in _meetings(group, False, percent):
            own = flat[ends[i]: ends[i + 1]]
            marked[own] = True
            for other in others:
                theirs = flat[ends[other]: ends[other + 1]]
                common = np.count_nonzero(marked[theirs])
                if 100 * common >= percent * (len(own) + len(theirs) - common):
                    found.append((min(rep[i], rep[other]), max(rep[i], rep[other])))
            marked[own] = False
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])


def _links_in_cells(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links (a, b) between rows of one cell. No pair becomes a row before it is known to be a link.

    Rows without a near one are left out first. The others get their sets, once for each key in which they meet
    one, and cells whose sets are too many for a task are cut again on both sides.
    """
    rows = settled(cells.mapInArrow(partial(_meeting, percent=percent), cells.schema), "meeting")
    asks, many = F.col("asks"), lambda mine: F.greatest(
        F.lit(1), F.ceil(F.sum(F.when(mine, F.col("n_shingles"))) / BLOCK_SHINGLES)).cast("long")
    sizes = settled(rows.groupBy("key", "cell").agg(many(asks).alias("parts"), many(~asks).alias("blocks")), "weights")
    dealt = F.pmod(F.xxhash64(F.lit(1), "rep"), F.when(asks, F.col("parts")).otherwise(F.col("blocks")))
    cut = rows.join(sizes, ["key", "cell"]).withColumn("own", dealt).withColumn(
        "met", F.explode(F.sequence(F.lit(0).cast("long"), F.when(asks, F.col("blocks")).otherwise(F.col("parts")) - 1)))
    # A number by hash: two cells that get the same one are compared as one, which finds the same links.
    cell = F.xxhash64("cell", F.when(asks, F.col("own")).otherwise(F.col("met")), F.when(asks, F.col("met")).otherwise(F.col("own")))
    whole = cut.withColumn("cell", cell).drop("parts", "blocks", "own", "met").join(sets, "rep")
    links = settled(whole.repartition("key", "cell").sortWithinPartitions("key", "cell").mapInArrow(
        partial(_linked, percent=percent), "a long, b long"), "links")
    discard(cells.sparkSession, rows, sizes)
    return links


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class representatives whose full sets reach the similarity."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b")), "b").join(
        sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a")), "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return settled(both.where(100 * shared >= percent * (F.size("set_a") + F.size("set_b") - shared)).select("a", "b"), "links")


def _cells(members: DataFrame, placed: DataFrame, classes: DataFrame, nearest: bool) -> DataFrame:
    """Rows of the keys whose members lie in several components, as those that ask and those that are held.

    The members outside the key's largest component ask, all are held, so a key of g members of which m are not in it
    costs m x g comparisons. With ``nearest`` a row asks in its largest key only. Either side is cut into blocks,
    and a cell holds a block of each.
    """
    rows = members.join(placed, "rep", "left").select("key", "rep", "size", F.coalesce("component", "rep").alias("component"))
    split = settled(rows.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("size")).where("top.n < size").select(
        "key", F.col("top.component").alias("main")), "split")
    asks = rows.join(split, "key").where("component <> main").select("key", "rep", "size", "component")
    if nearest:
        asks = asks.groupBy("rep").agg(F.max(F.struct("size", "key", "component")).alias("x")).select("rep", "x.*")
    asks = settled(asks, "asks")
    parts = settled(asks.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("parts")).join(split, "key"), "parts")
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = lambda n: F.pmod(F.xxhash64("rep"), n)
    range_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    cell = (F.col("part") * blocks + F.col("block")).alias("cell")
    held = rows.join(parts, "key").select(
        "*", range_of(F.col("parts")).alias("part"), dealt(blocks).alias("block")).select(
        "key", cell, "rep", "component", F.lit(False).alias("asks"), (F.col("component") != F.col("main")).alias("apart_from_main"))
    asking = asks.join(parts, "key").select(
        "*", range_of(blocks).alias("block"), dealt(F.col("parts")).alias("part")).select(
        "key", cell, "rep", "component", F.lit(True).alias("asks"), F.lit(True).alias("apart_from_main"))
    return held.unionByName(asking).join(classes.select("rep", "n_shingles", "signature"), "rep").repartition(
        "key", "cell").sortWithinPartitions("key", "cell")


def near_components(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    Documents are linked when 100 x shared shingles >= ``percent`` x all shingles of the two (percent of at least
    80, see ``reach``); a component is named by its smallest doc_id and that document is kept.
    Null and empty texts have no shingles and link with nothing; rows of a null doc_id are kept and link with nothing;
    repeated rows are one node (an id is taken to name one text); other columns are ignored; an empty table gives
    an empty result.

    Equal sets are one class first, so copies never meet as pairs. Each class is then compared with one first member
    of its keys, that of most of them, and in further rounds with the nearest one that its component does not hold
    yet. Where the members of a key are still in several components, all pairs between these follow that are near
    enough: they are looked at inside their cell, which gives out links alone. So a group of g near copies costs about g comparisons, and no link is left out
    unless its ends are already connected.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"the keys are made for a similarity of at least {LEAST_PERCENT} of 100")
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = settled(docs.mapInArrow(
        _sign, "doc_id long, n_shingles long, set_a long, set_b long, signature binary"), "signed")
    name = ["n_shingles", "set_a", "set_b"]
    classes = settled(signed.where("n_shingles > 0 and doc_id is not null").groupBy(*name).agg(
        F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature")), "classes")
    keys = classes.select("rep", "signature").mapInArrow(partial(_keys, n=reach(percent)[0]), "key long, rep long")
    # Written first, so that the join below shuffles both sides and can split a very common key.
    shared = settled(keys.groupBy("key").agg(
        F.min("rep").alias("pivot"), F.max("rep").alias("top"), F.count("*").alias("size")).where("pivot <> top"), "shared")
    members = settled(keys.join(shared, "key").select("key", "rep", "pivot", "size"), "members")
    ids = settled(members.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    asked = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    sets = settled(docs.join(asked, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, shingles array<long>").dropDuplicates(
        ["doc_id"]).withColumnRenamed("doc_id", "rep"), "sets")

    most = members.where("rep <> pivot").groupBy("rep", "pivot").agg(F.count("*").alias("n")).groupBy("rep").agg(
        F.max(F.struct("n", (-F.col("pivot")).alias("before"))).alias("m"))
    links = [_confirm(most.select((-F.col("m.before")).alias("a"), F.col("rep").alias("b")), sets, percent)]
    placed, groups = _placed(links[0]), members.select("key", "rep", "size")
    for turn in range(NEAREST_ROUNDS + 1):
        cells = _cells(groups, placed, classes, turn < NEAREST_ROUNDS)
        if turn < NEAREST_ROUNDS:
            near = cells.mapInArrow(partial(_nearest, percent=percent), "a long, b long, apart long").groupBy("a").agg(
                F.min(F.struct("apart", "b")).alias("n")).select("a", "n.b")
            links.append(_confirm(near, sets, percent))
        else:
            links.append(_links_in_cells(cells, sets, percent))
        placed = _placed(links[-1], placed)
    by_class = classes.join(placed, "rep", "left").select(*name, F.coalesce("component", "rep").alias("component"))
    out = signed.join(by_class, name, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    discard(spark, shared, members, sets, ids, *links)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _placed(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The component of each linked row, from new links and the components so far."""
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if before is not None:
        edges = edges.union(before.select(F.col("rep").alias("u"), F.col("component").alias("v")))
    return components(edges).withColumnRenamed("node", "rep")
