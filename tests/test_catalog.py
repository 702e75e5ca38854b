"""Every query against its SQL on the smallest given tables."""

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from txvigil.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "events", "orders", "lineitem"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    rows = QUERIES[name](spark, FOLDER)
    columns = sorted(rows.columns)
    result = Counter(tuple(r) for r in rows.select(columns).collect())
    expected = sql.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert result == Counter(expected)
    assert result


def test_entry(spark):
    assert entry(spark).count() == 245
