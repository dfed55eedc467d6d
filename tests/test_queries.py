"""Registered queries against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from bench import HEADLINE
from cohortspark.plans.registry import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    return v


# every third headline query; tools/check.py runs them all
@pytest.mark.parametrize("name", [n for n in HEADLINE if n in entry.oracle_sql()][::3])
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall()), key=repr)
    assert got == want and got


def test_every_query_is_named_once_and_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["grp", "quartile", "n", "percent"] and df.count() > 0
