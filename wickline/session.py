"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_own_folders: dict[str, str] = {}


def build_session(app: str = "wickline", **settings: str) -> SparkSession:
    """A session with adaptive execution and a UTC clock; extra settings override."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Candle times are UTC wall clock, so instants and wall clock must coincide."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, as the cluster names it.

    Only a local session without that setting (a laptop, the tests) gets a temporary folder; on a cluster each
    machine would have its own, so there the setting must be made.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    named = named or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="wickline-")
    return _own_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new location below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settled(df, label: str):
    """Write an intermediate result once and read it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
