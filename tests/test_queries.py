"""Every registered query against its SQL, on whole tables."""

import glob
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from tidemark.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return format(value, "f") if isinstance(value, Decimal) else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
