"""Every registered query equals its DuckDB twin (small scale factor)."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as ent
from encore.plans.registry import QUERIES

from .conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ent.oracle_sql()) and set(QUERIES) <= set(ent.queries())
    assert set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF_SMALL)
    res = duck.execute(ent.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_entry(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns == ["PERIOD", "NBR", "NAME", "RSI", "RSI_RANK", "data_dt"]


def test_columns_are_named(spark):
    """Every output column is aliased (no generated names) and unique."""
    for name, fn in QUERIES.items():
        cols = fn(spark, SF_SMALL).columns
        assert len(cols) == len(set(cols)), name
        assert not any("(" in c or " " in c for c in cols), (name, cols)
