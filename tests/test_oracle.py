"""Every registered query that SQL can express against DuckDB over the small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as library
from kgloom.plans.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.8g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=str)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, db, name):
    got = QUERIES[name](spark, SF)
    want = db.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert library.entry(spark).count() > 0
