"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from staylens.plans import registry

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda v: round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    return sorted((tuple(str(one(float(r[i])) if isinstance(r[i], int) and not isinstance(r[i], bool) else one(r[i])) for i in order) for r in rows))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want.fetchall(), want.columns)


def test_all_queries_have_names():
    assert set(SQL) <= set(QUERIES)
