"""Every query with SQL against DuckDB on the smallest data; the rest must return rows."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as wiring
import check_queries as check

SF_DIR = "/root/testdata/sf0.001"
WITH_SQL = sorted(wiring.oracle_sql())


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_sql(spark, con, name):
    status, detail, _ = check.compare(spark, con, name, SF_DIR)
    assert status == "ok", detail


def test_entry(spark):
    df = wiring.entry(spark)
    assert df.count() > 0 and "risk_level" in df.columns


def test_wiring():
    assert set(wiring.oracle_sql()) <= set(wiring.queries())
    assert len(wiring.queries()) >= 100
