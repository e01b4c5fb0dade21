"""Every named query equals its SQL twin on the smallest tables, and keeps its columns and types."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

NAMES = sorted(entry.queries())


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "none"
    if isinstance(v, float):
        return f"{v + 0.0:.9g}"
    return v.isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, data, con, name):
    df = entry.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(norm(r[i]) for i in order) for r in cursor.fetchall())


def test_entry(spark, data):
    assert entry.entry(spark).limit(1).count() == 1
