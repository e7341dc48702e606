from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wickline.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.ui.enabled": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


RAW_ROWS = [
    # Three raw candles one minute apart and what the cast must make of them.
    (1624393200000, "30000.0", "30100.0", "29950.0", "30050.0", "10.0", 1624393260000, "300500.0", 100, "5.0", "150250.0", "ignore1"),
    (1624393260000, "30050.0", "30150.0", "30000.0", "30100.0", "20.0", 1624393320000, "602000.0", 200, "10.0", "301000.0", "ignore2"),
    (1624393320000, "30100.0", "30200.0", "30050.0", "30150.0", "30.0", 1624393380000, "904500.0", 300, "15.0", "452750.0", "ignore3"),
]


@pytest.fixture(scope="session")
def raw_candles(spark):
    from pyspark.sql import functions as F

    from wickline import schemas
    from wickline.functions.clock import wall_clock

    df = spark.createDataFrame(RAW_ROWS, schemas.struct_of({c: schemas.RAW[c] for c in schemas.PAGE_COLUMNS}))
    wall = wall_clock(F.col("open_time"))
    return df.select(wall.alias("utc_datetime"), "*", wall.alias("updated_at"))
