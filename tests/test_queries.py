"""Registered queries against their SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from snapforge.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from read_parquet('{SF}/{f}')")
    return con


def told(df):
    return sorted(tuple(str(v) for v in r) for r in df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None).itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    if sql := queries.ORACLE_SQL.get(name):
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns) and told(got) == told(want)


def test_entry(spark):
    assert "Value_Changed" in entry.entry(spark).columns and set(entry.oracle_sql()) <= set(entry.queries())
