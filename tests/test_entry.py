"""The driver contract: entry, queries and their DuckDB twins (sf0.001)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from postscope.plans import catalog as C

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "top_user"]
    assert len(df.collect()) > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(C.ORACLE_SQL))
def test_matches_oracle(spark, con, name):
    df = C.QUERIES[name](spark, SF)
    cur = con.execute(C.ORACLE_SQL[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _key(df.columns, df.collect()) == _key(ocols, cur.fetchall())


def test_every_library_query_has_an_oracle():
    assert set(C.QUERIES) == set(C.ORACLE_SQL)
