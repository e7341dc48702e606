"""Immutable run snapshots, content fingerprints and versioned reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.functions.hashing import leading_int

MANIFEST = T.StructType([T.StructField(n, t) for n, t in [
    ("run_id", T.StringType()), ("stage", T.StringType()), ("source", T.StringType()), ("query", T.StringType()),
    ("rows", T.LongType()), ("cols", T.IntegerType()), ("bytes", T.LongType()), ("format", T.StringType()),
    ("fingerprint", T.StringType()), ("path", T.StringType()), ("run_ts", T.TimestampNTZType()),
    ("seconds", T.DoubleType())]])


def snapshot_path(root: str, dataset: str, table: str, run_ts: datetime) -> str:
    """Where a run's copy lies; a table name must be given."""
    if not table:
        raise ValueError("a source table name is required")
    return f"{root}/{dataset}/{table}/run={run_ts:%Y%m%dT%H%M%S}"


def snapshot_csv(df: DataFrame, root: str, dataset: str, table: str, run_ts: datetime) -> str:
    """Write a run's rows as CSV; a run that already has its snapshot fails."""
    path = snapshot_path(root, dataset, table, run_ts)
    df.write.option("header", True).csv(path)
    return path


def read_csv_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed read-back; values that do not fit the schema fail instead of turning NULL."""
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


def save_extract(df: DataFrame, root: str, name: str, stage: str) -> str:
    """Keep the raw or the processed extract of a training run under a fixed name."""
    if stage not in ("raw", "processed"):
        raise ValueError("stage is raw or processed")
    path = f"{root}/{stage}/{name}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def row_text(columns: list[str]) -> Column:
    """A row as one text that no other row has: each cell with its length before it, NULL as a mark of its own."""
    cells = [F.col(c).cast("string") for c in columns]
    return F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in cells])


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count and order-insensitive content mark: equal for equal bags of rows. Two sums of independent 60-bit parts of the
    rows' digests."""
    digest = F.md5(row_text(columns or df.columns))
    sums = [F.coalesce(F.sum(part.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).cast("string")
            for part in (leading_int(digest, 15), leading_int(F.substring(digest, 16, 15), 15))]
    return df.agg(F.count("*").alias("rows"), F.concat_ws("-", *sums).alias("fingerprint"))


def dataset_profile(df: DataFrame, source: str, files: bool = False) -> DataFrame:
    """One row about a dataset; ``files`` adds the count and bytes of the files behind it."""
    facts = [F.lit(source).alias("source"), F.lit(len(df.columns)).alias("cols")]
    if not files:
        return df.agg(F.count("*").alias("rows")).select(*facts, "rows")
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("size"))
    kind = F.max(F.substring_index("file", ".", -1))
    return per_file.agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("size").alias("bytes"),
                        kind.alias("format")).select(*facts, "rows", "files", "bytes", "format")


def record_run(spark: SparkSession, manifest: str, **facts) -> None:
    """Append one row to the run manifest."""
    row = tuple(facts.get(f.name) for f in MANIFEST.fields)
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(manifest)


def save_version(df: DataFrame, root: str, name: str, run_ts: datetime) -> str:
    """Store a dataset version and note its fingerprint in the manifest; returns the fingerprint."""
    path = f"{root}/versions/{name}/{run_ts:%Y%m%dT%H%M%S}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    mark = fingerprint(stored).first()
    record_run(df.sparkSession, f"{root}/manifest", stage="version", source=name, rows=mark["rows"],
               cols=len(df.columns), format="parquet", fingerprint=mark["fingerprint"], path=path, run_ts=run_ts)
    return mark["fingerprint"]


def read_version(spark: SparkSession, root: str, name: str, mark: str) -> DataFrame:
    """Read the newest version of a dataset with the given fingerprint."""
    known = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    hit = (known.where((F.col("stage") == "version") & (F.col("source") == name) & (F.col("fingerprint") == mark))
           .agg(F.max_by("path", "run_ts").alias("path")).first())
    if hit["path"] is None:
        raise ValueError(f"no version {mark} of {name}")
    return spark.read.parquet(hit["path"])
