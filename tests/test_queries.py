"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA, plan_of

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    number = float(value)
    return None if math.isnan(number) else number


def _sorted(rows):
    rows = [tuple(_plain(v) for v in r) for r in rows]
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, TESTDATA)
    sql = entry.oracle_sql()[name]
    columns = sorted(df.columns)
    expected = duck.sql(sql)
    assert sorted(expected.columns) == columns
    listed = ", ".join(f'"{c}"' for c in columns)
    want = _sorted(duck.sql(f"SELECT {listed} FROM ({sql})").fetchall())
    got = _sorted(df.select(*[f"`{c}`" for c in columns]).collect())
    assert got == want
    plan = plan_of(df)
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["cust_id", "cust_name", "total"]
    assert df.count() > 0
