"""The correctness gate in miniature: every query with an oracle equals
DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.sql(entry.oracle_sql()[name])
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in res.columns)
    assert _rows(df.columns, srows) == _rows(res.columns, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 5
