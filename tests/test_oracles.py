"""Every registered query with SQL against DuckDB on the smallest tables; the others must give rows."""

import math
import os

import duckdb
import pandas as pd
import pytest

from loamline.plans import queries as q

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def cell(v):
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return "NULL"
    if isinstance(v, bool) or str(type(v)).find("bool") >= 0:
        return str(bool(v))
    if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf":
        return f"{float(v):.6f}"
    return str(v)


def rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(map(cell, r)) for r in df[names].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, duck, name):
    got = q.QUERIES[name](spark, SF).toPandas()
    assert len(got) > 0
    if name in q.ORACLES:
        assert rows(got) == rows(duck.sql(q.ORACLES[name]).df())
