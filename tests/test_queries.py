"""Every registered query against its SQL twin."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from auditlake.oracles import ORACLES
from auditlake.queries import QUERIES
from conftest import SF_DIR
from oracle_check import connect, differences

DIR = os.environ.get("AUDITLAKE_TEST_SF", SF_DIR)


@pytest.fixture(scope="module")
def duck():
    with connect(DIR) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLES.items() <= entry_points.oracle_sql().items()
    assert len(QUERIES) == 80


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    relation = duck.sql(ORACLES[name])
    assert differences(QUERIES[name](spark, DIR), relation) == []


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["scan_table", "stream_ingest", "https_only"])
def test_tables_may_be_folders(spark, name, small_dir, tmp_path):
    for table in ("events", "pages"):
        spark.read.parquet(f"{small_dir}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    found = QUERIES[name](spark, str(tmp_path))
    expected = QUERIES[name](spark, small_dir)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
