"""Every query runs on the smallest tables, and those with SQL equal it."""

from __future__ import annotations

import datetime
import os

import duckdb
import pytest

from restitch.plans import registry

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(_norm, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    text = registry.oracle_sql().get(name)
    if text is None:
        assert rows
        return
    cur = duck.execute(text)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted((tuple(_norm(r[i]) for i in at) for r in cur.fetchall()), key=repr)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(registry.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1
