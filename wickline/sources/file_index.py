"""What each data file of a table holds, kept beside the table, so that later runs need not open old files."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.sources.paths import path_exists

#: Files that a filter names at most; with more new ones the whole table is described again.
MOST_NAMED = 10_000
_FOLDS = {"min": F.min, "max": F.max, "sum": F.sum}


def _present(table: DataFrame) -> DataFrame:
    """(file): the files of the table, written as in its rows' metadata, where an empty authority has no slashes."""
    files = [(re.sub(r"^([^:/]+):///", r"\1:/", f),) for f in table.inputFiles()]
    return table.sparkSession.createDataFrame(files, "file string")


@dataclass(frozen=True)
class FileIndex:
    """Measures of each data file by key, one row a file, in the folder ``path``.

    ``measures`` maps a name to an expression over the table's rows and to how it is put together (min, max or sum).
    A file's row is written whole or not at all, and a file without a row counts as new, so an index that is
    behind, half written or absent costs time, never a result. Files that are gone no longer count. Each
    refresh that meets new files adds one small file to the index.
    """

    path: str
    keys: Mapping[str, Column]
    measures: Mapping[str, tuple[Column, str]]

    def _described(self, table: DataFrame) -> DataFrame:
        """(file, entries): the measures of each key in each file of ``table``."""
        rows = table.select(F.col("_metadata.file_path").alias("~file"), *[c.alias(k) for k, c in self.keys.items()],
                            *[c.alias(m) for m, (c, _) in self.measures.items()])
        by_key = rows.groupBy("~file", *self.keys).agg(*[_FOLDS[how](m).alias(m) for m, (_, how) in self.measures.items()])
        return by_key.groupBy(F.col("~file").alias("file")).agg(
            F.collect_list(F.struct(*self.keys, *self.measures)).alias("entries"))

    def _known(self, spark: SparkSession, like: DataFrame) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], like.schema)
        # Two runs may have described the same file.
        stored = spark.read.schema(like.schema).parquet(self.path)
        return stored.groupBy("file").agg(F.any_value("entries").alias("entries"))

    def new_files(self, table: DataFrame) -> list[str]:
        """The files of the table that the index does not know."""
        known = self._known(table.sparkSession, self._described(table))
        return [r["file"] for r in _present(table).join(known, "file", "left_anti").collect()]

    def refresh(self, table: DataFrame) -> int:
        """Describe the files that are new; only they are opened. Returns their number."""
        files = self.new_files(table)
        if files:
            place = F.col("_metadata.file_path")
            if len(files) <= MOST_NAMED:
                fresh = table.where(place.isin(files))  # decided from the listing, before any file is opened
            else:
                fresh = table
            self._described(fresh).coalesce(1).write.mode("append").parquet(self.path)
        return len(files)

    def read(self, table: DataFrame) -> DataFrame:
        """Keys and measures of the whole table, after a refresh, from the index alone."""
        self.refresh(table)
        known = self._known(table.sparkSession, self._described(table))
        entries = known.join(_present(table), "file", "left_semi").select(F.inline("entries"))
        return entries.groupBy(*self.keys).agg(*[_FOLDS[how](m).alias(m) for m, (_, how) in self.measures.items()])
