"""Every query with SQL against DuckDB on the small tables."""

import os

import duckdb
import pytest

from basketspark import registry

DATA = "/root/testdata/sf0.001"
TABLES = "customer orders lineitem part supplier events documents".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: "" if v is None else f"{v:.9f}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", registry.ORACLE_SQL)
def test_query_matches_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    got = rows(got.columns, got.collect())
    assert got == rows(want.columns, want.fetchall())
    assert got
