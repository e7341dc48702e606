"""Files that are not opened again, versions that are claimed once, and the log of parameters."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_quality_and_loading import candles, new_market
from wickline.operators import registry
from wickline.plans.dataops import days_behind, lagging_days, run_dataops
from wickline.sources import paths
from wickline.sources.file_index import FileIndex
from wickline.sources.kline_pages import write_kline_pages

DAY = 1440


def data_files(market, table):
    return sorted(Path(market.root.removeprefix("file:"), "tables", table).rglob("*.parquet"))


def index_of(path):
    return FileIndex(path, {"k": F.col("k")}, {"top": (F.col("v"), "max"), "low": (F.col("v"), "min"), "n": (F.lit(1).cast("long"), "sum")})


def held(index, table):
    return {r["k"]: (r["top"], r["low"], r["n"]) for r in index.read(table).collect()}


def test_incremental_load_opens_no_old_file(spark, tmp_path):
    """The files of the first load are spoiled; the second load, of later days, does not notice."""
    market, run = new_market(spark), datetime(2024, 1, 1)
    write_kline_pages(candles(spark, 2 * DAY), str(tmp_path / "a"), "1m")
    assert run_dataops(spark, str(tmp_path / "a"), market, run) == {"raw": 2 * DAY, "transformed": 2 * DAY}
    assert run_dataops(spark, str(tmp_path / "a"), market, run + timedelta(1)) == {"raw": 0, "transformed": 0}
    old = data_files(market, market.raw_table) + data_files(market, market.transformed_table)
    assert old
    for file in old:
        file.write_bytes(b"spoiled")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        spark.table(market.raw).agg(F.max("open_time")).collect()
    later = candles(spark, 2 * DAY + 7, start=0).unionByName(candles(spark, 3, "ETH", start=2 * DAY))
    write_kline_pages(later, str(tmp_path / "b"), "1m")
    assert run_dataops(spark, str(tmp_path / "b"), market, run + timedelta(2)) == {"raw": 10, "transformed": 10}
    assert run_dataops(spark, str(tmp_path / "b"), market, run + timedelta(3)) == {"raw": 0, "transformed": 0}
    assert market.raw_index.new_files(spark.table(market.raw)) == []


def test_lost_index_changes_nothing(spark, tmp_path):
    market, run = new_market(spark), datetime(2024, 1, 1)
    write_kline_pages(candles(spark, 20), str(tmp_path / "a"), "1m")
    run_dataops(spark, str(tmp_path / "a"), market, run)
    paths.remove(spark, f"{market.root}/index")
    write_kline_pages(candles(spark, 25), str(tmp_path / "b"), "1m")
    assert run_dataops(spark, str(tmp_path / "b"), market, run + timedelta(1)) == {"raw": 5, "transformed": 5}
    raw, done = spark.table(market.raw), spark.table(market.transformed)
    assert lagging_days(spark, market) == days_behind(raw, done) == []


def test_index_follows_its_table(spark, tmp_path):
    """New files are added, gone files no longer count, names with blanks and signs are met, a file described twice counts once."""
    folder = str(tmp_path / "a table 100%")
    table = lambda: spark.read.schema("k string, v int, part string").parquet(folder)
    index = index_of(str(tmp_path / "index"))
    rows = [("a", 1, "x y"), ("a", 5, "50%"), ("b", 2, "ü=1"), (None, 7, "x y")]
    spark.createDataFrame(rows, "k string, v int, part string").write.partitionBy("part").parquet(folder)
    assert held(index, table()) == {"a": (5, 1, 2), "b": (2, 2, 1), None: (7, 7, 1)}
    assert index.refresh(table()) == 0
    spark.createDataFrame([("b", -1, "new")], "k string, v int, part string").write.mode("append").partitionBy("part").parquet(folder)
    assert len(index.new_files(table())) == 1
    assert held(index, table()) == {"a": (5, 1, 2), "b": (2, -1, 2), None: (7, 7, 1)}
    again = spark.read.parquet(index.path)
    again.write.parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("append").parquet(index.path)
    assert held(index, table())["a"] == (5, 1, 2)
    for file in Path(folder).rglob("*.parquet"):
        if "part=new" in str(file):
            file.unlink()
    assert held(index, table())["b"] == (2, 2, 1)


def test_index_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.createDataFrame([], "k string, v int").write.parquet(folder)
    assert held(index_of(str(tmp_path / "i")), spark.read.schema("k string, v int").parquet(folder)) == {}


def test_versions_are_claimed_once(spark, tmp_path):
    root, runs = str(tmp_path), [f"run{i}" for i in range(16)]
    with ThreadPoolExecutor(16) as pool:
        got = list(pool.map(lambda r: registry.claim_version(spark, root, "direction/1m", r, 1, {"kind": "test"}), runs))
    assert sorted(got) == list(range(1, 17))
    assert registry.claim_version(spark, root, "direction/1m", "run3", 1, {"kind": "test"}) == got[3]
    assert registry.claim_version(spark, root, "other", "run3", 4) == 4
    tags = {(r["version"], r["run_id"], r["tag"], r["value"]) for r in registry.version_tags(spark, root, "direction/1m").collect()}
    assert tags == {(v, r, "kind", "test") for v, r in zip(got, runs)}
    assert [r["tag"] for r in registry.version_tags(spark, root, "other").collect()] == [None]


def test_shared_file_systems_make_a_file_once(spark, tmp_path):
    target = spark._jvm.org.apache.hadoop.fs.Path(str(tmp_path / "x" / "claim.json"))
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    assert paths._created(system, target, "ä first") and not paths._created(system, target, "second")
    assert (tmp_path / "x" / "claim.json").read_text(encoding="utf-8") == "ä first"


def test_parameters_are_logged_as_texts(spark):
    wide = spark.createDataFrame([(3, 0.5, None, "l2")], "depth int, alpha double, gap double, penalty string")
    rows = {(r["run_id"], r["name"], r["value"]) for r in registry.log_params("r1", wide).collect()}
    assert rows == {("r1", "depth", "3"), ("r1", "alpha", "0.5"), ("r1", "gap", None), ("r1", "penalty", "l2")}
