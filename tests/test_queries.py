"""Every registered query runs on the smallest tables and equals its SQL there."""

import datetime
import decimal

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, small, name):
    df = entry.queries()[name](spark, small)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows is not None
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, rows) == table(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
