"""Registered queries against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "NULL" if math.isnan(value) else repr(round(value, 6))
        return "NULL" if value is None else repr(value)

    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    got = _comparable([tuple(row) for row in result.collect()], result.columns)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = _comparable(cursor.fetchall(), columns)
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got[1] == expected[1]


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    result = entry(spark)
    assert result.columns[0] == "SOURCEURL"
    assert result.count() > 0
