"""Every registered query with SQL gives the rows that DuckDB gives."""

import math

import duckdb
import pytest

from rosterworks.plans.registry import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{ROOT}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "~"
    if isinstance(value, bool):
        return str(int(value))
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, ROOT)
    columns = sorted(frame.columns)
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in result.fetchall())
    assert mine == theirs and mine


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
