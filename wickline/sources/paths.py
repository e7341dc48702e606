"""Existence of a path on whatever file system Spark uses."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return True
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that only its maker knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there. Of several writers at once one succeeds, the others get False.

    Shared file systems make a file only once if asked so; on a local one a link to the finished file does.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getScheme() != "file":
        return _created(system, target, text)
    place = target.toUri().getPath()
    os.makedirs(os.path.dirname(place), exist_ok=True)
    draft = f"{place}.{uuid.uuid4().hex}"
    with open(draft, "x", encoding="utf-8") as file:
        file.write(text)
    try:
        os.link(draft, place)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)


def _created(system, target, text: str) -> bool:
    try:
        stream = system.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return True
