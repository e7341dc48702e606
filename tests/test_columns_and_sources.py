"""Interval texts, casts, page plans, page files, tables and snapshots."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from wickline import schemas
from wickline.functions.intervals import interval_to_millis, millis_of, try_interval_to_millis
from wickline.operators import casting, quality
from wickline.session import fresh_path
from wickline.sources import kline_pages, snapshots, tables


def test_interval_texts(spark):
    df = spark.createDataFrame([("1m",), ("2h",), ("3d",)], "i string")
    assert [r[0] for r in df.select(interval_to_millis(F.col("i"))).collect()] == [60000, 7200000, 259200000]
    assert millis_of("2h") == 7_200_000


@pytest.mark.parametrize("text", ["1w", "1M", "5s", "m", ""])
def test_bad_interval_fails(spark, text):
    df = spark.createDataFrame([(text,)], "i string")
    assert df.select(try_interval_to_millis(F.col("i"))).first()[0] is None
    with pytest.raises(Exception, match="Invalid interval format"):
        df.select(interval_to_millis(F.col("i"))).collect()
    with pytest.raises(ValueError):
        millis_of(text)


def test_page_plan_covers_the_range(spark):
    minute = 60_000
    df = spark.createDataFrame([("A", 0, 2500 * minute), ("B", 0, 1000 * minute), ("C", 5, 5)],
                               "symbol string, start_time bigint, end_time bigint")
    rows = kline_pages.plan_pages(df, "1m", 1000).orderBy("symbol", "page").collect()
    assert [(r["symbol"], r["start_time"] // minute, r["end_time"] // minute) for r in rows] == [
        ("A", 0, 1000), ("A", 1000, 2000), ("A", 2000, 2500), ("B", 0, 1000), ("C", 0, 0)]


def test_raw_rows_become_typed_rows(raw_candles):
    rows = casting.cast_klines(raw_candles).orderBy("open_time").collect()
    first = datetime(2021, 6, 22, 20, 20)
    for i, r in enumerate(rows):
        at = first + timedelta(minutes=i)
        assert r["utc_datetime"] == r["open_time"] == r["updated_at"] == at
        assert r["close_time"] == at + timedelta(minutes=1)
        assert r["utc_singapore_datetime"] == at + timedelta(hours=8)
        assert (r["open"], r["close"], r["volume"]) == (30000.0 + 50 * i, 30050.0 + 50 * i, 10.0 * (i + 1))
        assert r["number_of_trades"] == 100 * (i + 1) and r["ignore"] == f"ignore{i + 1}"
    assert casting.cast_klines(raw_candles).columns == list(schemas.TRANSFORMED)


def test_cleaning_and_target(raw_candles):
    df = casting.with_price_increase(casting.cast_columns(raw_candles, casting.CLEANING_TYPES))
    assert [r[0] for r in df.select("price_increase").collect()] == [1, 1, 1]
    flat = df.withColumn("close", F.col("open"))
    assert {r[0] for r in casting.with_price_increase(flat).select("price_increase").collect()} == {0}
    assert casting.select_features_target(df).columns == [*schemas.FEATURES, "price_increase"]
    assert len(casting.select_features_target(df, target=["price_increase", "close"]).columns) == 9
    with pytest.raises(ValueError):
        casting.select_features_target(df, ["nothing"])


def test_bad_number_fails_the_strict_cast(raw_candles):
    bad = raw_candles.withColumn("open", F.lit("n/a"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        casting.cast_klines(bad).collect()
    assert {r[0] for r in casting.cast_columns(bad, {"open": "double"}, strict=False).select("open").collect()} == {None}


def test_unknown_type_fails():
    with pytest.raises(ValueError):
        schemas.struct_of({"a": "interval"})


def test_pages_round_trip_and_whole_file_pages(spark, raw_candles, tmp_path):
    candles = raw_candles.select(F.lit("BTC").alias("symbol"), *schemas.PAGE_COLUMNS)
    kline_pages.write_kline_pages(candles, str(tmp_path / "p"), "1m", limit=2)
    assertDataFrameEqual(kline_pages.read_kline_pages(spark, str(tmp_path / "p")).select(candles.columns), candles)
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "page.json").write_text('[[1, "2.0", "3", "1",\n "2", "9", 5, "1", 7, "1", "1", "0"]]')
    row = kline_pages.read_kline_pages(spark, str(tmp_path / "one"), page_per_file=True).first()
    assert (row["open_time"], row["open"], row["number_of_trades"]) == (1, "2.0", 7)


def test_load_dispositions(spark):
    df = spark.range(5)
    name = "disposition_table"
    tables.append_table(df, name, tables.WRITE_EMPTY, location=fresh_path(spark, name))
    with pytest.raises(ValueError, match="already holds rows"):
        tables.append_table(df, name, tables.WRITE_EMPTY)
    tables.append_table(df, name, tables.WRITE_APPEND)
    assert spark.table(name).count() == 10
    tables.append_table(spark.range(2), name, tables.WRITE_TRUNCATE)
    assert spark.table(name).count() == 2
    with pytest.raises(ValueError):
        tables.append_table(df, name, "WRITE_SOMETIMES")
    tables.create_table(spark, "empty_one", df.schema, fresh_path(spark, "empty"))
    tables.append_table(df, "empty_one", tables.WRITE_EMPTY)
    assert spark.table("empty_one").count() == 5


def test_snapshots_are_immutable_and_typed(spark, raw_candles, tmp_path):
    run = datetime(2024, 1, 1)
    path = snapshots.snapshot_csv(raw_candles, str(tmp_path), "market", "raw", run)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        snapshots.snapshot_csv(raw_candles, str(tmp_path), "market", "raw", run)
    assertDataFrameEqual(snapshots.read_csv_snapshot(spark, path, raw_candles.schema), raw_candles)
    with pytest.raises(ValueError):
        snapshots.snapshot_csv(raw_candles, str(tmp_path), "market", "", run)


def test_fingerprint_ignores_order_and_sees_content(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(2, None), (1, "x")], "i int, s string")
    c = spark.createDataFrame([(2, None), (1, "y")], "i int, s string")
    marks = [snapshots.fingerprint(d).first()["fingerprint"] for d in (a, b, c)]
    assert marks[0] == marks[1] != marks[2]
    assert snapshots.fingerprint(a.limit(0)).first()["rows"] == 0


def test_versions_by_fingerprint(spark, tmp_path):
    root = str(tmp_path)
    first = snapshots.save_version(spark.range(3), root, "ids", datetime(2024, 1, 1))
    snapshots.save_version(spark.range(4), root, "ids", datetime(2024, 1, 2))
    assert snapshots.read_version(spark, root, "ids", first).count() == 3
    with pytest.raises(ValueError):
        snapshots.read_version(spark, root, "ids", "0")


def test_file_profile(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t"))
    row = snapshots.dataset_profile(spark.read.parquet(str(tmp_path / "t")), "t", files=True).first()
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert (row["rows"], row["files"], row["bytes"], row["format"], row["cols"]) == (10, 3, size, "parquet", 1)


def test_promotion_needs_a_passing_gate(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, v double")
    gate = quality.quality_gate(df, {"positive": F.col("v") > 0}, ["k"])
    with pytest.raises(ValueError, match="duplicate_key"):
        tables.promote_table(df, "promoted", gate)
    good = quality.quality_gate(df, {"positive": F.col("v") > 0}, ["k", "v"])
    tables.promote_table(df, "promoted", good, location=fresh_path(spark, "promoted"))
    assert spark.table("promoted").count() == 2


def test_only_files_landed_since_are_read(spark, raw_candles, tmp_path):
    import os

    pages = str(tmp_path / "p")
    candles = raw_candles.select(F.lit("BTC").alias("symbol"), *schemas.PAGE_COLUMNS)
    kline_pages.write_kline_pages(candles.limit(1), pages, "1m")
    for f in (tmp_path / "p").rglob("*.txt"):
        os.utime(f, (1_600_000_000, 1_600_000_000))
    kline_pages.write_kline_pages(candles, pages, "1m", mode="append")
    since = datetime(2022, 1, 1)
    assert kline_pages.read_kline_pages(spark, pages).count() == 4
    assert kline_pages.read_kline_pages(spark, pages, landed_after=since).count() == 3
