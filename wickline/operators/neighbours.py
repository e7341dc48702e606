"""Exact nearest neighbours of many rows among many rows, with missing values.

Distance: squared differences over the features both rows have, scaled by (all features / shared ones).
Donors are cut into cells by a k-d tree over all features, and by which of their features are missing, so that every cell has a
box and one set of known features. The distance of a query to the box bounds that to every donor in it. A query first
searches the nearest cells that hold k donors; rings of further cells follow, nearest first, until no unvisited box is nearer
than its k-th candidate. Cells are split into blocks of bounded size on both sides, so a value shared by very many rows stays
spread out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.functions.hashing import hashed_int
from wickline.session import settled

BLOCK_ROWS = 20_000
#: Rows that the tree's splits are taken from, and its greatest number of leaves. Which rows these are changes what is
#: visited, not what is found: the boxes are those of all donors.
SAMPLE_ROWS, MOST_LEAVES = 200_000, 4096
#: Cells that a query visits beside its first ones before its bound is looked at again.
RING = 4


class Tree:
    """Splits along the widest feature at its middle, and a leaf for each row."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.middle = np.nan_to_num(np.nanmean(np.vstack([sample, np.zeros(sample.shape[1])]), axis=0)) if len(sample) else np.zeros(sample.shape[1])
        sample = np.where(np.isnan(sample), self.middle, sample)
        self.feature, self.threshold, self.children, self.leaves = [], [], [], 0
        self._grow(sample, leaves)
        self.feature, self.threshold, self.children = np.array(self.feature), np.array(self.threshold), np.array(self.children).reshape(-1, 2)

    def _grow(self, rows: np.ndarray, leaves: int) -> int:
        """The node of these rows; leaves are numbered -1, -2 and on."""
        wide = int(np.argmax(rows.var(axis=0))) if leaves > 1 and len(rows) > 1 else 0
        cut = float(np.median(rows[:, wide])) if leaves > 1 and len(rows) > 1 else 0.0
        left = rows[:, wide] <= cut if leaves > 1 and len(rows) > 1 else np.ones(len(rows), dtype=bool)
        if left.all():
            self.leaves += 1
            return -self.leaves
        node = len(self.feature)
        self.feature.append(wide)
        self.threshold.append(cut)
        self.children.append((0, 0))
        self.children[node] = self._grow(rows[left], leaves // 2), self._grow(rows[~left], leaves - leaves // 2)
        return node

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        rows = np.where(np.isnan(rows), self.middle, rows)
        node = np.full(len(rows), 0 if len(self.feature) else -1)
        while (open_rows := np.flatnonzero(node >= 0)).size:
            at = node[open_rows]
            right = rows[open_rows, self.feature[at]] > self.threshold[at]
            node[open_rows] = self.children[at, right.astype(int)]
        return -1 - node


def _features(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    return np.stack([batch.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features], axis=1)


def _place(batches: Iterator[pa.RecordBatch], tree: Tree, features: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.leaf(_features(batch, features)), pa.int64())],
                                         names=[*batch.schema.names, "leaf"])


def box_distances(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rows x cells: the least distance to anything in a cell's box; infinite where no feature is shared."""
    total, shared = np.zeros((len(rows), len(low))), np.zeros((len(rows), len(low)))
    for j in range(rows.shape[1]):
        q = rows[:, j][:, None]
        off = np.maximum(np.maximum(low[None, :, j] - q, q - high[None, :, j]), 0.0)
        known = ~np.isnan(off)
        total += np.where(known, off * off, 0.0)
        shared += known
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, total * (rows.shape[1] / shared), np.inf)


def _wanted(batches: Iterator[pa.RecordBatch], features: Sequence[str], cells: tuple[np.ndarray, ...], k: int, ring: int) -> Iterator[pa.RecordBatch]:
    """The cells that each query visits in a ring: in the first the nearest that hold more than ``k`` donors; in later ones,
    of the cells within its ``bound``, those whose places by distance follow those it has ``seen``."""
    low, high, donors = cells
    for batch in batches:
        query, cell, place = [], [], []
        rows, ids = _features(batch, features), batch.column("query_id").to_numpy()
        bounds = batch.column("bound").to_numpy(zero_copy_only=False).astype(float)
        seen = batch.column("seen").to_numpy(zero_copy_only=False).astype(np.int64)
        for start in range(0, len(rows), 256):
            distance = box_distances(rows[start:start + 256], low, high)
            order = np.argsort(distance, axis=1, kind="stable")
            for i, (d, o) in enumerate(zip(distance, order), start):
                end = int(np.searchsorted(d[o], np.inf))
                if ring == 0:
                    last = int(np.searchsorted(np.cumsum(donors[o]), k + 1)) + 1
                else:
                    last = int(np.searchsorted(d[o], bounds[i] * (1 + 1e-9) + 1e-300, side="right")) if not np.isnan(bounds[i]) else end
                    last = min(last, seen[i] + RING) if ring == 1 else last
                mine = o[seen[i]:min(last, end)]
                query.append(np.full(len(mine), ids[i]))
                cell.append(mine)
                place.append(np.full(len(mine), seen[i] + len(mine)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *x]), pa.int64()) for x in (query, cell, place)],
                                         names=["query_id", "cell", "seen"])


def _block_search(features: Sequence[str], k: int, visited: Accumulator | None = None, chunk: int = 256):
    """Top k donors of every query in one block pair, as pandas rows."""
    names = list(features)
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "donor_id": pd.Series(dtype="int64"),
                          "value": pd.Series(dtype="float64"), "distance": pd.Series(dtype="float64")})

    def search(queries: pd.DataFrame, donors: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or donors.empty:
            return empty
        if visited is not None:
            visited.add(len(queries) * len(donors))
        donors = donors.sort_values("donor_id", kind="stable")
        d = donors[names].to_numpy(float)
        ids, values = donors["donor_id"].to_numpy(), donors["value"].to_numpy(float)
        out = []
        for start in range(0, len(queries), chunk):
            part = queries.iloc[start:start + chunk]
            q = part[names].to_numpy(float)
            total = np.zeros((len(q), len(d)))
            shared = np.zeros((len(q), len(d)))
            for j in range(len(names)):
                step = q[:, j][:, None] - d[:, j][None, :]
                known = ~np.isnan(step)
                total += np.where(known, step * step, 0.0)
                shared += known
            with np.errstate(divide="ignore", invalid="ignore"):
                dist = np.where(shared > 0, total * (len(names) / shared), np.inf)
            dist[part["query_id"].to_numpy()[:, None] == ids[None, :]] = np.inf
            kth = np.partition(dist, min(k, dist.shape[1]) - 1, axis=1)[:, min(k, dist.shape[1]) - 1]
            rows, cols = np.nonzero((dist <= kth[:, None]) & np.isfinite(dist))
            picked = dist[rows, cols]
            order = np.lexsort((cols, picked, rows))
            rows, cols, picked = rows[order], cols[order], picked[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
            rows, cols, picked = rows[place < k], cols[place < k], picked[place < k]
            out.append(pd.DataFrame({"query_id": part["query_id"].to_numpy()[rows], "donor_id": ids[cols],
                                     "value": values[cols], "distance": picked}))
        return pd.concat(out) if out else empty

    return search


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest per query; at most k per block reach this window."""
    w = Window.partitionBy("query_id").orderBy("distance", "donor_id")
    return candidates.withColumn("nearest", F.row_number().over(w)).where(F.col("nearest") <= k)


def nearest_neighbours(queries: DataFrame, donors: DataFrame, key: str, features: Sequence[str], value: str,
                       k: int, block_rows: int = BLOCK_ROWS, visited: Accumulator | None = None) -> DataFrame:
    """(query_id, donor_id, value, distance, nearest): the k nearest donors with a ``value`` of each query.

    Keys are whole numbers, unique over both tables; a row is never its own donor. Ties go to the lower key. A row
    that shares no known feature with a donor is at no distance from it. ``visited`` counts the pairs that were compared.
    """
    spark, features = queries.sparkSession, list(features)
    void = F.lit(None).cast("double")
    numbers = [F.nanvl(F.col(f).cast("double"), void).alias(f) for f in features]
    pool = settled(donors.where(F.col(value).isNotNull()).select(
        F.col(key).cast("bigint").alias("donor_id"), F.col(value).cast("double").alias("value"), *numbers), "donors")
    asks = settled(queries.select(F.col(key).cast("bigint").alias("query_id"), *numbers), "asks")
    found_type = "query_id bigint, donor_id bigint, value double, distance double"
    n = pool.count()
    if n == 0:
        return spark.createDataFrame([], f"{found_type}, nearest int")
    sample = pool.select(*features) if n <= SAMPLE_ROWS else pool.select(*features).sample(SAMPLE_ROWS / n, 7).limit(2 * SAMPLE_ROWS)
    tree = Tree(np.array([list(r) for r in sample.toPandas().to_numpy(dtype=float)]).reshape(-1, len(features)), min(MOST_LEAVES, -(-n // block_rows)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pool.schema.fields)
    known = F.concat(*[F.col(f).isNotNull().cast("int").cast("string") for f in features]).alias("known")
    placed = settled(pool.mapInArrow(partial(_place, tree=tree, features=features), f"{schema}, leaf long").withColumn("known", known), "placed")
    # One row for each cell: leaves times the sets of known features that occur.
    boxes = placed.groupBy("leaf", "known").agg(
        F.count("*").alias("donors"), *[g(f).alias(f"{g.__name__}_{i}") for i, f in enumerate(features) for g in (F.min, F.max)]).orderBy("leaf", "known").toPandas()
    low, high = (boxes[[f"{g}_{i}" for i in range(len(features))]].to_numpy(dtype=float) for g in ("min", "max"))
    cells = (low, high, boxes["donors"].to_numpy())
    blocks = spark.createDataFrame(
        [(int(r.leaf), r.known, i, max(1, -(-int(r.donors) // block_rows))) for i, r in enumerate(boxes.itertuples())],
        "leaf long, known string, cell long, blocks int")
    pool = placed.join(F.broadcast(blocks), ["leaf", "known"]).withColumn(
        "block", (hashed_int("block", F.col("donor_id")) % F.col("blocks")).cast("int"))
    search = _block_search(features, k, visited)

    def visit(wanted: DataFrame) -> DataFrame:
        """Search (query, cell) pairs; queries of a crowded cell are cut into groups as well."""
        load = wanted.groupBy("cell").agg(F.count("*").alias("n"))
        load = load.select("cell", F.ceil(F.col("n") / F.lit(block_rows)).cast("int").alias("groups"))
        plan = blocks.select("cell", "blocks").join(load, "cell")
        mine = wanted.join(F.broadcast(plan), "cell").withColumn(
            "part", (hashed_int("part", F.col("query_id")) % F.col("groups")).cast("int"))
        mine = mine.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        theirs = pool.drop("blocks").join(F.broadcast(plan.select("cell", "groups")), "cell").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        slot = ["cell", "block", "part"]
        return mine.select(*slot, "query_id", *features).groupBy(*slot).cogroup(
            theirs.select(*slot, "donor_id", "value", *features).groupBy(*slot)).applyInPandas(search, found_type)

    best = spark.createDataFrame([], f"{found_type}, nearest int")
    state = asks.withColumns({"bound": void, "seen": F.lit(0).cast("long")})
    for ring in range(3):
        wanted = settled(state.select("query_id", *features, "bound", "seen").mapInArrow(
            partial(_wanted, features=features, cells=cells, k=k, ring=ring), "query_id long, cell long, seen long"), "ring")
        found = visit(wanted.join(asks, "query_id").select("query_id", "cell", *features))
        best = settled(_best(best.select("query_id", "donor_id", "value", "distance").unionByName(found), k), "near")
        if ring == 2:
            break
        bound = best.where(F.col("nearest") == k).select("query_id", F.col("distance").alias("bound"))
        seen = wanted.groupBy("query_id").agg(F.max("seen").alias("now"))
        state = state.drop("bound").join(seen, "query_id", "left").withColumn("seen", F.coalesce("now", "seen")).drop("now").join(
            bound, "query_id", "left")
    return best


def knn_impute(df: DataFrame, train: DataFrame, key: str, features: Sequence[str], column: str,
               k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fill the missing cells of a column with the mean over the k nearest training rows that have it.

    A row without any neighbour gets the training mean.
    """
    gaps = df.where(F.col(column).isNull())
    near = nearest_neighbours(gaps, train, key, features, column, k, block_rows)
    fills = near.groupBy("query_id").agg(F.avg("value").alias("__fill"))
    fallback = train.agg(F.avg(F.col(column).cast("double")).alias("m")).first()["m"]
    joined = df.join(fills, F.col(key) == F.col("query_id"), "left")
    filled = F.coalesce(F.col(column).cast("double"), F.col("__fill"), F.lit(fallback))
    return joined.select(*[filled.alias(c) if c == column else F.col(c) for c in df.columns])


def knn_classify(queries: DataFrame, train: DataFrame, key: str, features: Sequence[str], label: str,
                 k: int = 8, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Majority class among the k nearest training rows, the lowest class on ties: (key, y_pred, votes)."""
    near = nearest_neighbours(queries, train, key, features, label, k, block_rows)
    votes = near.groupBy("query_id", "value").agg(F.count("*").alias("n"))
    top = votes.groupBy("query_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("t"))
    return top.select(F.col("query_id").alias(key), F.col("t.value").cast("int").alias("y_pred"),
                      (-F.col("t.n")).alias("votes"))


def knn_impute_columns(df: DataFrame, train: DataFrame, key: str, columns: Sequence[str], k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fill the missing cells of every column from the nearest training rows by all ``columns`` as they came, unfilled.

    Columns of whole numbers become doubles where they are filled; a NaN is missing too.
    """
    void = F.lit(None).cast("double")
    clean = lambda frame: frame.withColumns({c: F.nanvl(F.col(c).cast("double"), void) for c in columns})
    df, train = clean(df), clean(train)
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    out = df
    for c in [c for c in columns if missing[c]]:
        filled = knn_impute(df, train, key, columns, c, k, block_rows).select(F.col(key).alias("__key"), F.col(c).alias("__value"))
        out = out.join(filled, F.col(key) == F.col("__key"), "left").withColumn(c, F.col("__value")).drop("__key", "__value")
    return out
