"""Null cells, broken and overlapping pages, masked lagging days, null groups, and the shared folder."""

from __future__ import annotations

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from wickline import schemas, session
from wickline.operators.metrics import overall_metrics
from wickline.operators.resampling import group_kfold
from wickline.plans.dataops import days_behind
from wickline.sources.kline_pages import parse_kline_pages, read_kline_pages, write_kline_pages
from wickline.streaming.sources import close_stream

NAMES = ", ".join(f"{c} {'long' if c in schemas.PAGE_INTEGERS else 'string'}" for c in schemas.PAGE_COLUMNS)


def test_null_and_quoted_cells_keep_their_place(spark, tmp_path):
    row = (60000, "1.0", None, '0"9\\', "1.5", "10.0", 119999, "15.0", None, "5.0", "7.0", "ignore")
    write_kline_pages(spark.createDataFrame([row], NAMES).withColumn("symbol", F.lit("A")), str(tmp_path / "p"), "1m")
    got = read_kline_pages(spark, str(tmp_path / "p")).first()
    assert tuple(got[c] for c in schemas.PAGE_COLUMNS) == row


@pytest.mark.parametrize("page", ["[[1,2]]", "{", "[[", "x", "[1]"])
def test_broken_pages_fail(spark, page):
    with pytest.raises(Exception, match="not a page of candles"):
        parse_kline_pages(spark.createDataFrame([(page,)], "value string")).collect()


def test_blank_lines_and_empty_pages_hold_nothing(spark):
    assert parse_kline_pages(spark.createDataFrame([("[]",), (" ",)], "value string")).count() == 0


def test_equal_counts_of_other_keys_are_behind(spark):
    day = date(2021, 6, 22)
    raw = spark.createDataFrame([(day, "A", 0), (day, "A", 60000)], "day date, symbol string, open_time long")
    done = raw.select("day", "symbol", F.timestamp_millis("open_time").cast("timestamp_ntz").alias("open_time"))
    twice = done.where("open_time = timestamp_ntz'1970-01-01 00:00:00'")
    assert days_behind(raw, done) == [] and days_behind(raw.union(raw), done) == []
    assert days_behind(raw, twice.union(twice)) == [day]


def test_rows_without_a_group_stay(spark):
    rows = spark.createDataFrame([(i, None if i % 2 else i % 7, i % 3 == 0) for i in range(100)], "id int, g int, p boolean")
    folds = group_kfold(rows, "g", F.col("p"))
    assert folds.count() == 100 and folds.where("g is null").select("fold").distinct().count() == 1
    scored = spark.createDataFrame([(None if i % 2 else "a", i % 3 % 2, i / 50) for i in range(50)], "k string, y int, p double")
    scored = scored.withColumn("y_pred", (F.col("p") > 0.5).cast("int"))
    assert {r.k for r in overall_metrics(scored, ["k"]).collect()} == {None, "a"}


def test_a_cluster_needs_a_shared_folder(spark):
    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn", getConf=lambda: conf, applicationId="x"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(cluster)


def test_an_ended_stream_keeps_its_last_windows_and_goes_on(spark, tmp_path):
    schema = "ts timestamp, n long"
    landed = str(tmp_path / "landed")
    land = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
    at = lambda h, m: datetime(2024, 1, 1, h, m)

    def totals():
        rows = spark.readStream.schema(schema).parquet(landed).withWatermark("ts", "10 minutes")
        sums = rows.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.sum("n").alias("n")).select("w.start", "n")
        return sorted((r.start.hour, r.n) for r in close_stream(sums, ["start"], str(tmp_path / "out"), str(tmp_path / "check")).collect())

    land([(at(1, 5), 1), (at(1, 50), 2), (at(2, 0), 4)])
    assert totals() == [(1, 3), (2, 4)]
    assert totals() == [(1, 3), (2, 4)]
    land([(at(2, 30), 8), (at(3, 1), 16)])
    assert totals() == [(1, 3), (2, 12), (3, 16)]
