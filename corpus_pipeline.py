"""A corpus from raw documents to token ids: each stage is one operator and works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm import pieces, severity
from wickline.llm.decontaminate import leaks
from wickline.llm.near_join import near_components
from wickline.llm.queries import TOKENIZERS
from wickline.llm.spans import discard, table
from wickline.llm.suffix_dedup import remove_repeats
from wickline.session import settled


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic. The grades are learned from the labels of this stage's documents."""
    graded = severity.grade(docs, severity.fit(docs, table(spark, sf_dir, "labels")))
    return graded.where(~F.col("toxic")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies, linked at 80 of 100."""
    kept = near_components(docs, 80).where("kept").select("doc_id").distinct()
    # Rows that repeat an id are copies as well: one of them stays. Null ids link with nothing.
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    repeated = docs.join(ids.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    single = docs.join(ids.select("doc_id"), "doc_id", "left_anti") if not ids.isEmpty() else docs
    rows = single.unionByName(repeated) if single is not docs else docs
    nameless = docs.where("doc_id is null")
    return rows.join(kept.where("doc_id is not null"), "doc_id", "left_semi").select(*docs.columns).unionByName(nameless)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without passages of more than 50 words, and whole characters inside byte strings of 400, that occur
    more than once."""
    return remove_repeats(docs, 400, whole_characters=True, keep=True, words=51)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, also those that are shorter than it. A row of null id is known by its text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.sha2(F.coalesce("text", F.lit("")), 256)))
    named = docs.select(name.alias("doc_id"), "text")
    found = leaks(named, table(spark, sf_dir, "benchmark"), 0.8, short=True).select(F.col("doc_id").alias("leaked")).distinct()
    return docs.join(found, name == F.col("leaked"), "left_anti")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents with their piece ids and the text that these decode to."""
    model = pieces.share_model(spark, f"{TOKENIZERS}/piece_bpe_32k.model")
    return pieces.recode(docs, model).drop("text")


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("decontamination", decontamination), ("encoding", encoding)]
#: The fit, the hash anchors and the shortest paths are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(spark, before)
        before = docs
    return docs
