"""Every named query with SQL gives the same rows as that SQL in another engine."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for file in os.listdir(SMALL):
        connection.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def rows(records):
    return sorted((tuple(plain(v) for v in r) for r in records), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    ours = rows(tuple(r[c] for c in columns) for r in frame.collect())
    relation = duck.sql(SQL[name])
    positions = [list(relation.columns).index(c) for c in columns]
    theirs = rows(tuple(r[i] for i in positions) for r in relation.fetchall())
    assert columns == sorted(relation.columns)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_without_sql_return_rows(spark, name):
    frame = QUERIES[name](spark, SMALL)
    assert frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 12
