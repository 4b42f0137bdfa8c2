"""Layer (c): every registered query against its DuckDB oracle on sf0.001 (sf0.01 via tools/oracle_check.py)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from curata.plans import catalog
from curata.sources.tables import TABLES

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)
    s_idx = [sdf.columns.index(c) for c in order]
    d_idx = [rel.columns.index(c) for c in order]
    srows = Counter(tuple(norm(r[i]) for i in s_idx) for r in sdf.collect())
    drows = Counter(tuple(norm(r[i]) for i in d_idx) for r in rel.fetchall())
    assert srows == drows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns
