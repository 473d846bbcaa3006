"""Every registered query with an oracle equals DuckDB on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

from conftest import SMALL

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(res.columns)
    assert _rows(sdf.columns, srows) == _rows(res.columns, res.fetchall())


def test_every_query_has_a_callable():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90
