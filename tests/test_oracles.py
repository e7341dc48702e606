"""Every registered query with a SQL twin, against DuckDB. Queries that train models run with WICKLINE_SLOW=1."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, tables_in  # noqa: E402

SLOW = {"serve_production", "initial_load", "incremental_load", "stream_ingest", "oof_predictions", "batch_score", "model_roundtrip"}
NAMES = [n for n in entry.oracle_sql() if n not in SLOW or os.environ.get("WICKLINE_SLOW")]


@pytest.fixture(scope="module")
def con(sf):
    return tables_in(sf)


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, con, sf, name):
    said = compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name])
    assert said.startswith("ok ") and "kinds" not in said, said
