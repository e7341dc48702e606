"""Streams over landed files and the tables they fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_files(spark: SparkSession, folder: str, name: str, schema: T.StructType, per_trigger: int = 100) -> DataFrame:
    """Parquet files of one table as they appear in a folder."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", per_trigger)
            .parquet(folder))


def append_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that has arrived into a Parquet table, exactly once, then stop."""
    query = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
             .option("path", path).trigger(availableNow=True).start())
    query.awaitTermination()


def close_stream(df: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Every window of an aggregated stream that has ended, also those that no later row has closed.

    Each micro-batch writes the windows that it changed under its own number, so a repeated batch replaces itself;
    of each window (``keys``) the last version counts. Run again after more rows arrive, the windows go on.
    """
    spark = df.sparkSession
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/batch=-1")  # a stream without rows has no batch
    query = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")).start())
    query.awaitTermination()
    written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    last = written.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return written.join(last, [*keys, "batch"]).select(*df.columns)


def each_batch(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch to a batch job; the checkpoint remembers what has been handed over."""
    query = df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
