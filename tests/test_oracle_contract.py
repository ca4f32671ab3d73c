"""Every registered query against its DuckDB oracle on the smallest test tables (the driver's
correctness gate, run in the test suite)."""

import datetime
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tablemover.queries import TABLES

from smallest import SF


def _norm(v):
    if v is None or isinstance(v, (bool, int, str)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want
