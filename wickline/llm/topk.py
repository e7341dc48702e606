"""Exact top-k by inner product with the threshold algorithm over sorted lists, one per dimension."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickline.llm.spans import small_batches

#: Rows of a block of candidates and of a block of queries; one task holds one of each.
CANDIDATES, QUERIES = 16_384, 2_048
#: How deep the lists are read before the bound is first compared; the depth then doubles.
DEPTH = 16


class SortedLists:
    """A block of vectors with, for each dimension, its rows in ascending order of that component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(vectors, self.order.T, axis=0).T.copy()

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best rows whose id is not ``own``; ties go to the smaller id.

        Each list is read from the end that scores best with the query's component. A row not yet met scores
        at most the sum of the components where the lists stand, so reading stops once that is below
        the kth score; an equal bound goes on, as an unseen row could still win the tie.
        """
        n = len(self.ids)
        up = query > 0
        lists = np.flatnonzero(query)
        met = np.zeros(n, dtype=bool)
        best, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=self.vectors.dtype)
        done, depth = 0, min(DEPTH, n)
        if not len(lists):
            met[:] = True
            best = np.flatnonzero(self.ids != own)
            best = best[np.argsort(self.ids[best], kind="stable")][:k]
            return best, np.zeros(len(best), dtype=self.vectors.dtype)
        while True:
            span = [self.order[d, n - depth: n - done] if up[d] else self.order[d, done:depth] for d in lists]
            fresh = np.zeros(n, dtype=bool)
            fresh[np.concatenate(span)] = True
            rows = np.flatnonzero(fresh & ~met)
            met |= fresh
            rows = rows[self.ids[rows] != own]
            rows, gained = np.r_[best, rows], np.r_[scores, self.vectors[rows] @ query]
            first = np.lexsort((self.ids[rows], -gained))[:k]
            best, scores = rows[first], gained[first]
            if depth == n:
                return best, scores
            stands = np.where(up[lists], self.sorted[lists, n - depth], self.sorted[lists, depth - 1])
            if len(best) == k and stands @ query[lists] < scores[-1]:
                return best, scores
            done, depth = depth, min(2 * depth, n)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), -1)


def _search(asked: pa.Table, block: pa.Table, k: int) -> pa.Table:
    """The k best of one block of candidates for each query of one block."""
    out: list[list] = [[], [], [], []]
    if asked.num_rows and block.num_rows:
        queries, rows = _matrix(asked.column("vector")), _matrix(block.column("vector"))
        widest = int(np.abs(queries).max()) * int(np.abs(rows).max()) * queries.shape[1] if queries.size else 0
        if widest < 1 << 53:  # exact in floating point, which multiplies faster
            queries, rows = queries.astype(np.float64), rows.astype(np.float64)
        lists = SortedLists(block.column("vec_id").to_numpy(), rows)
        for own, ask, query in zip(asked.column("vec_id").to_numpy(), asked.column("ask").to_numpy(), queries):
            best, scores = lists.search(query, own, k)
            out[0].extend([own] * len(best))
            out[1].extend(lists.ids[best].tolist())
            out[2].extend(int(s) for s in scores)
            out[3].extend([ask] * len(best))
    return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score", "ask"])


def integer_vectors(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and ``vector`` as floor(scale x) longs. Rows of a null id or vector, or of a null, NaN or infinite
    component, are left out."""
    x = F.col("v")
    sound = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & x.isNotNull() & sound).select(
        "vec_id", F.transform(x, lambda c: F.floor(c * scale)).alias("vector"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows of another id by integer inner product.

    ``vectors`` has vec_id and ``vector`` (longs). Only vectors of the query's length are its candidates. Ties go
    to the smaller vec_id; a query with fewer candidates gets them all; a repeated row is a candidate for each
    repetition, but asks once. Rows of one id and different vectors ask apart, each with ranks of its own. An empty
    table, or one without queries, gives an empty result.

    Rows and queries are dealt into blocks of bounded size by a hash, so a third of equal vectors spreads out, and
    every block of queries meets every block of rows. The k best of each meeting are then ranked.
    """
    small_batches(vectors.sparkSession)
    vectors = vectors.withColumn("dims", F.size("vector"))
    queries = vectors.where(is_query).select("dims", "vec_id", "vector").distinct().withColumn("ask", F.xxhash64("vec_id", "vector"))
    n, n_queries = vectors.count(), queries.count()
    blocks, query_blocks = -(-max(n, 1) // CANDIDATES), -(-max(n_queries, 1) // QUERIES)
    blocks = max(blocks, min(6, n // 1024))
    salt = lambda count: F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asked = queries.withColumn("q", F.pmod("ask", F.lit(query_blocks)).cast("int")).withColumn("b", every(blocks))
    rows = vectors.select("dims", "vec_id", "vector", salt(blocks).alias("b")).withColumn("q", every(query_blocks))
    names = ["dims", "q", "b"]
    met = asked.groupBy(*names).cogroup(rows.groupBy(*names)).applyInArrow(
        lambda key, asked, block: _search(asked, block, k), "query_id long, vec_id long, score long, ask long")
    order = Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

