"""Catalog tables: creation, first-run test, load dispositions, promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The load dispositions of the warehouse.
WRITE_APPEND, WRITE_EMPTY, WRITE_TRUNCATE = "WRITE_APPEND", "WRITE_EMPTY", "WRITE_TRUNCATE"


def dataset_exists(spark: SparkSession, dataset: str) -> bool:
    return spark.catalog.databaseExists(dataset)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def is_first_run(spark: SparkSession, dataset: str, table: str) -> bool:
    """True until both the dataset and the table exist."""
    return not dataset_exists(spark, dataset) or not table_exists(spark, f"{dataset}.{table}")


def create_dataset(spark: SparkSession, dataset: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {dataset}{place}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partition_by: list[str] = ()) -> None:
    """An empty Parquet table of a declared layout."""
    if not table_exists(spark, name):
        writer = spark.createDataFrame([], schema).write.format("parquet").option("path", location)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def append_table(df: DataFrame, name: str, disposition: str = WRITE_APPEND, schema: T.StructType | None = None,
                 location: str | None = None, partition_by: list[str] = ()) -> None:
    """Load rows under a disposition. A schema, if given, orders and casts the columns."""
    spark = df.sparkSession
    if schema is not None:
        df = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    exists = table_exists(spark, name)
    if disposition == WRITE_EMPTY and exists and not spark.table(name).isEmpty():
        raise ValueError(f"{name} already holds rows")
    modes = {WRITE_APPEND: "append", WRITE_EMPTY: "append", WRITE_TRUNCATE: "overwrite"}
    if disposition not in modes:
        raise ValueError(f"unknown disposition {disposition}")
    if exists:
        df = df.select(*spark.table(name).columns)
        if disposition == WRITE_TRUNCATE:
            df.write.insertInto(name, overwrite=True)
            return
    if partition_by:
        df = df.hint("rebalance", *partition_by)  # few files per partition; a large partition is split
    writer = df.write.mode(modes[disposition]).format("parquet")
    if location and not exists:
        writer = writer.option("path", location)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def query_table(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Run SQL over catalog tables and the frames given by name."""
    return spark.sql(sql, **views)


def promote_table(staging: DataFrame, target: str, gate: DataFrame, disposition: str = WRITE_TRUNCATE,
                  location: str | None = None) -> None:
    """Copy a staging table to production once its quality gate reports no failed rule."""
    failed = [r["rule"] for r in gate.where("not passed").select("rule").collect()]
    if failed:
        raise ValueError(f"quality gate failed: {sorted(failed)}")
    append_table(staging, target, disposition, location=location)
