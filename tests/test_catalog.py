"""Every query with SQL gives the same rows as DuckDB; the others run."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from fenlark.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, list):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    other = duck.sql(catalog.ORACLES[name])
    assert sorted(other.columns) == cols
    expected = [tuple(plain(r[other.columns.index(c)]) for c in cols) for r in other.fetchall()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
