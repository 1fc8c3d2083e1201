"""Every registered query against its SQL counterpart, on the smallest data set."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        connection.execute(f"create view {table} as select * from read_parquet('{SF}/{name}')")
    return connection


def value(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return str(v) if isinstance(v, (dt.date, dt.datetime)) else v


def table(rows, columns, wanted):
    index = [columns.index(c) for c in wanted]
    out = [tuple(value(r[i]) for i in index) for r in rows]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert {q.__name__ for q in contract.QUERIES} <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [q.__name__ for q in contract.QUERIES])
def test_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    cursor = con.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = table(cursor.fetchall(), columns, sorted(columns))
    got = table(df.collect(), df.columns, sorted(columns))
    assert got == want


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["bar_ts", "sector", "sector_pct_change", "n_tickers"]
    assert df.count() > 0
