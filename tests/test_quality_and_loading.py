"""Validation rules, gaps, comparisons and the batch and streaming loads."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wickline import schemas
from wickline.operators import incremental, quality, shaping
from wickline.plans.dataops import Market, run_dataops, transform_pending
from wickline.session import fresh_path
from wickline.sources.kline_pages import write_kline_pages
from wickline.streaming.ingest import ingest_stream

MINUTE = 60_000


def candles(spark, n, symbol="BTC", start=0, bad=()):
    rows = []
    for i in range(start, start + n):
        price = "n/a" if i in bad else str(100.0 + i % 7)
        rows.append((symbol, i * MINUTE, price, "200.0", "50.0", "101.0", "3", i * MINUTE + MINUTE - 1, "300", 4, "1", "100", "0"))
    kinds = {c: schemas.RAW[c] for c in schemas.PAGE_COLUMNS}
    return spark.createDataFrame(rows, "symbol string, " + ", ".join(
        f"`{c}` {'bigint' if k == 'int' else 'string'}" for c, k in kinds.items()))


def failures(report):
    return {r["column"]: r["failures"] for r in report.collect()}


def test_lax_type_rules(spark):
    df = spark.createDataFrame([("1", 1.0, 1.5, "x", float("nan"), "2.5")], "a string, b double, c double, d string, e double, f string")
    got = failures(quality.validate_schema(df, {"a": "int", "b": "int", "c": "int", "d": "str", "e": "float", "f": "float", "z": "int"}))
    assert got == {"a": 0, "b": 0, "c": 1, "d": 0, "e": 0, "f": 0, "z": 1}
    assert failures(quality.validate_schema(df, {"b": "str", "d": "float"})) == {"b": 1, "d": 1}
    assert failures(quality.validate_schema(df, {"d": "datetime", "a": "bool"})) == {"d": 1, "a": 1}
    with pytest.raises(ValueError):
        quality.validate_schema(df, {"a": "money"})


def test_raw_rows_pass_and_raise(spark, raw_candles):
    quality.ensure_valid(quality.validate_schema(raw_candles, schemas.RAW))
    with pytest.raises(ValueError, match="volume"):
        quality.ensure_valid(quality.validate_non_null(raw_candles.withColumn("volume", F.lit(None).cast("string")), ["volume"]))
    with pytest.raises(ValueError, match="absent"):
        quality.ensure_valid(quality.validate_frame(raw_candles, {**schemas.RAW, "absent": "int"}))


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert failures(quality.validate_non_null(df, ["v"])) == {"v": 2}
    assert shaping.drop_missing(df, ["v"]).count() == 1


def test_gaps_across_blocks(spark):
    kept = [0, 1, 2, 5, 6, 30, 31, 31, 95, 96]
    df = spark.createDataFrame([("A", i * MINUTE) for i in kept] + [("B", 0)], "symbol string, open_time bigint")
    for slots in (1, 4, 1440):
        got = sorted((r["after_time"] // MINUTE, r["next_time"] // MINUTE, r["missing"])
                     for r in quality.find_gaps(df, MINUTE, slots=slots).collect())
        assert got == [(2, 5, 2), (6, 30, 23), (31, 95, 63)]


def test_frame_diff_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    got = {r["v"]: (r["in_actual"], r["in_expected"]) for r in quality.frame_diff(a, b).collect()}
    assert got == {1: (2, 1), 3: (0, 1)}


def test_dedupe_with_one_hot_key(spark):
    df = spark.range(1000).selectExpr("if(id < 400, 0, id) as k", "id as version", "id * 2 as payload")
    rows = shaping.dedupe_latest(df, ["k"], ["version"])
    assert rows.count() == 601 and rows.where("k = 0").first()["payload"] == 798


def test_clip_and_z(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(10_000.0,)], "v double")
    assert shaping.clip_outliers(df, ["v"], 0.0, 0.9).agg(F.max("v")).first()[0] < 100
    assert shaping.drop_outliers_z(df, ["v"]).agg(F.max("v")).first()[0] == 100.0


@pytest.mark.parametrize("limit", [1, 20_000])
def test_slice_after_watermark(spark, limit):
    every = candles(spark, 10).unionByName(candles(spark, 4, "ETH"))
    loaded = candles(spark, 6)
    out = incremental.incremental_slice(every, loaded, MINUTE, max_series=limit)
    assert {r["symbol"]: r["count"] for r in out.groupBy("symbol").count().collect()} == {"BTC": 4, "ETH": 4}
    known = incremental.incremental_slice(every, loaded, MINUTE, new_series=False, max_series=limit)
    assert {r["symbol"]: r["count"] for r in known.groupBy("symbol").count().collect()} == {"BTC": 4}
    nothing = incremental.incremental_slice(every, loaded.limit(0), MINUTE, max_series=limit)
    assert nothing.count() == 14


def new_market(spark):
    name = f"market_{uuid.uuid4().hex[:10]}"
    return Market(name, fresh_path(spark, name), MINUTE)


def test_loads_are_incremental_and_repeatable(spark, tmp_path):
    market, run = new_market(spark), datetime(2024, 1, 1)
    write_kline_pages(candles(spark, 1500), str(tmp_path / "a"), "1m")
    write_kline_pages(candles(spark, 1600).unionByName(candles(spark, 5, "ETH")), str(tmp_path / "b"), "1m")
    assert run_dataops(spark, str(tmp_path / "a"), market, run) == {"raw": 1500, "transformed": 1500}
    assert run_dataops(spark, str(tmp_path / "b"), market, run + timedelta(1)) == {"raw": 105, "transformed": 105}
    assert run_dataops(spark, str(tmp_path / "b"), market, run + timedelta(2)) == {"raw": 0, "transformed": 0}
    done = spark.table(market.transformed)
    assert done.count() == 1605 and done.select("symbol", "open_time").distinct().count() == 1605
    assert dict(done.dtypes)["open"] == "double" and dict(done.dtypes)["utc_singapore_datetime"] == "timestamp_ntz"


def test_failed_transform_leaves_no_gap(spark, tmp_path):
    """Unreadable prices stop the transform; once they are mended the same rows are caught up."""
    market, run = new_market(spark), datetime(2024, 1, 1)
    write_kline_pages(candles(spark, 5), str(tmp_path / "a"), "1m")
    run_dataops(spark, str(tmp_path / "a"), market, run)
    write_kline_pages(candles(spark, 8, bad=(6,)), str(tmp_path / "b"), "1m")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_dataops(spark, str(tmp_path / "b"), market, run + timedelta(1))
    assert spark.table(market.raw).count() == 8 and spark.table(market.transformed).count() == 5
    mended = spark.table(market.raw).withColumn("open", F.regexp_replace("open", "n/a", "1.0"))
    path = fresh_path(spark, "mended")
    mended.write.parquet(path)
    spark.read.parquet(path).write.insertInto(market.raw, overwrite=True)
    assert transform_pending(spark, market) == 3
    assert spark.table(market.transformed).count() == 8


def test_upsert_rewrites_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "d1", 1, "old"), (2, "d1", 1, "old"), (3, "d2", 1, "old")]
    spark.createDataFrame(rows, "k int, day string, v int, s string").write.partitionBy("day").parquet(path)
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "day=d2").glob("*.parquet")}
    changes = spark.createDataFrame([(1, "d1", 2, "new"), (4, "d1", 1, "new"), (2, "d1", 0, "late")], "k int, day string, v int, s string")
    incremental.write_upsert(path, changes, "day", ["k"], "v", str(tmp_path / "staging"))
    assert {(r["k"], r["s"]) for r in spark.read.parquet(path).collect()} == {(1, "new"), (2, "old"), (3, "old"), (4, "new")}
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "day=d2").glob("*.parquet")} == untouched


def test_stream_ingest_repeats_harmlessly(spark, tmp_path):
    market, pages, run = new_market(spark), str(tmp_path / "p"), datetime(2024, 1, 1)
    write_kline_pages(candles(spark, 20), pages, "1m")
    ingest_stream(spark, pages, market, str(tmp_path / "c"), run)
    write_kline_pages(candles(spark, 30), pages, "1m", mode="append")
    ingest_stream(spark, pages, market, str(tmp_path / "c"), run)
    ingest_stream(spark, pages, market, str(tmp_path / "other-checkpoint"), run)  # everything once more
    for name in (market.raw, market.transformed):
        assert spark.table(name).count() == 30 == spark.table(name).select("symbol", "open_time").distinct().count()
