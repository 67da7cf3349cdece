"""Every named query against its DuckDB text at sf0.001 (rows + values)."""

import datetime as dt
import hashlib

import pytest

import __spark_entry__ as E
from reachset.plans.named import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_every_query_has_sql():
    assert set(NAMES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["advertiserId", "company"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(rows) == len(d_rows)
    assert _digest(df.columns, rows) == _digest(d_cols, d_rows)
