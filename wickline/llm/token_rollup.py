"""Token totals by source, language and tokenizer version, kept up by signed deltas in batches."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.spans import small_batches

GROUP = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens"]
#: Fixed value: how byte-level vocabularies of 50 thousand cut a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encodings: dict[int, tiktoken.Encoding] = {}


def _encoding(ranks: bytes) -> tiktoken.Encoding:
    """One per worker and vocabulary: making it takes longer than a document."""
    name = hash(ranks)
    if name not in _encodings:
        pairs = (line.split() for line in ranks.splitlines() if line)
        _encodings[name] = tiktoken.Encoding("bytes", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            base64.b64decode(token): int(rank) for token, rank in pairs})
    return _encodings[name]


def bpe_counter(spark: SparkSession, vocabulary: str) -> Callable[[str], int]:
    """Counts tokens with a file of ranks (about 1 MB), which is read here and sent to each executor once."""
    with open(vocabulary, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    return lambda text: len(_encoding(ranks.value).encode_ordinary(text))


def word_count(text: str) -> int:
    return len(text.split())


def count_tokens(docs: DataFrame, counters: dict[str, Callable[[str], int]], text: str = "text") -> DataFrame:
    """``docs`` without ``text`` but with a long column for each tokenizer version. A null text has no tokens."""
    small_batches(docs.sparkSession)
    rest = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), *(f"`{c}` long" for c in counters)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            made = [pa.array([counter(t) if t else 0 for t in texts], pa.int64()) for counter in counters.values()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), *made], names=[*(f.name for f in rest), *counters])

    return docs.mapInArrow(count, schema)


def signed(changes: DataFrame) -> DataFrame:
    """Deltas of changes: source, lang, tokenizer, change (insert, delete or revise), old_tokens and new_tokens.

    An insert adds a document and its new tokens, a delete takes a document and its old ones away, a revision
    moves the tokens from old to new. Null counts are 0; null sources, languages and versions are groups of
    their own. Other changes raise an error when they are read.
    """
    old, new = F.coalesce("old_tokens", F.lit(0)), F.coalesce("new_tokens", F.lit(0))
    kind = F.coalesce("change", F.lit("null"))
    wrong = F.raise_error(F.concat(F.lit("no such change: "), kind)).cast("long")
    documents = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(wrong).cast("long")
    tokens = F.when(kind == "insert", new).when(kind == "delete", -old).otherwise(new - old).cast("long")
    return changes.select(*GROUP, documents.alias("documents"), tokens.alias("tokens"))


class TokenRollup:
    """Totals below ``path``. A batch is a folder of its pre-aggregated deltas and counts once it is complete.

    ``_SUCCESS``, which Spark writes last, is the commit: a batch that failed half-way is written anew, one that is
    complete is skipped when it comes again. Batches may be committed in any order, as totals only add. One
    batch id must not be written by two jobs at once. ``compact`` folds batches into one folder, whose list of
    folded ids is written last, so a reader sees each batch either alone or folded.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _complete(self, path: str) -> bool:
        target, fs = self._folder(f"{path}/_SUCCESS")
        return fs.exists(target)

    def _children(self, path: str) -> list[str]:
        target, fs = self._folder(path)
        names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
        return sorted(names)

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Add a batch once. Returns whether it was new."""
        path = f"{self.path}/batches/{batch_id}"
        if self._complete(path) or batch_id in self._folded():
            return False
        summed = deltas.groupBy(*GROUP).agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
        summed.write.mode("overwrite").parquet(path)
        return True

    def _fold(self) -> str | None:
        done = [n for n in self._children(f"{self.path}/folds") if self._complete(f"{self.path}/folds/{n}/ids")]
        return f"{self.path}/folds/{done[-1]}" if done else None

    def _folded(self) -> set[str]:
        fold = self._fold()
        return {r.batch for r in self.spark.read.parquet(f"{fold}/ids").collect()} if fold else set()

    def _parts(self) -> tuple[list[str], list[str]]:
        """Batches that are not folded yet, and the folders that make up the totals."""
        fold, folded = self._fold(), self._folded()
        fresh = [b for b in self._children(f"{self.path}/batches") if b not in folded and self._complete(f"{self.path}/batches/{b}")]
        return fresh, [f"{self.path}/batches/{b}" for b in fresh] + ([f"{fold}/totals"] if fold else [])

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents and tokens; groups whose sums are both 0 are left out."""
        _, folders = self._parts()
        schema = "source string, lang string, tokenizer string, documents long, tokens long"
        rows = self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
        return rows.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS]).where("documents <> 0 or tokens <> 0")

    def compact(self) -> None:
        fresh, _ = self._parts()
        ids = sorted({*fresh, *self._folded()})
        path = f"{self.path}/folds/{len(self._children(f'{self.path}/folds')):08d}"
        self.totals().write.mode("overwrite").parquet(f"{path}/totals")
        self.spark.createDataFrame([(b,) for b in ids], "batch string").write.mode("overwrite").parquet(f"{path}/ids")
