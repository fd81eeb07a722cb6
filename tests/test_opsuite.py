"""Every query with DuckDB SQL gives the same rows as that SQL on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

from claimforge.opsuite import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(x):
    if isinstance(x, float):
        return "nan" if x != x else float(f"{x:.10g}")
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    spark_rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    assert spark_rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=key)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
