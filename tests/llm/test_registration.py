"""The queries of this part are registered, and those with an oracle agree with it."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from curata.llm import catalog

SF_SMALL = "/root/testdata/sf0.001"
NAMES = ["op1_packing", "op2_sharding", "op3_bpe", "op4_hashing", "op5_personal", "op6_licences", "op7_pivots", "op8_minhash",
         "op9_language", "op10_quality", "op11_middle", "op12_rules", "op13_trie"]


def test_all_are_registered():
    assert set(NAMES) | {"pipeline"} <= set(entry.queries())
    assert set(catalog.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    df = catalog.QUERIES[name](spark, SF_SMALL)
    rel = con.sql(catalog.ORACLES[name])
    order = [rel.columns.index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[i] for i in order) for r in rel.fetchall())
