"""Conversation prefix trie: brute-force version, block edges, edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from curata.llm import catalog, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    """conv_id -> list of (role, text) after rebuilding."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, role or "", digest), (role or "", text or "")))
    turns = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - int(np.fmod(c, 100)), [])[:h] + t[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
        ends[tuple(t)].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        worth = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += worth
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends.get(p, [])))
                  for p, m in members.items())


def random_rows(seed, n=120, words=2, turns=6):
    random.seed(seed)
    rows = []
    for c in random.sample(range(0, 400), n):
        rows += [(c, random.choice([None, k]), random.choice(["user", None]), random.choice(["a", "bé", "", None][:words + 1]))
                 for k in range(random.randint(0, turns))]
    return rows


EDGE = [(None, 1, "user", "no conversation"), (100, None, None, None), (100, 1, "user", "x"), (100, 1, "user", "x"), (101, 5, "user", "y" * 50_000),
        (7, 1, "user", "alone"), (-250, 1, "user", "negative"), (-205, 1, "a", "b"), (-205, 2, "a", "b"), *[(300, k, "u", "long") for k in range(700)],
        *[(c, 1, "system", "the same") for c in range(1000, 1400)]]


def table(spark, rows):
    """Turns with extra columns whose names clash with the operator's own."""
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, depth long")
    return df.repartition(3)


def run(spark, data, **kw):
    out = trie.trie(trie.rebuilt(trie.conversations(table(spark, data))), **kw)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("rows,size", [(1 << 16, 4 << 20), (1, 1 << 20), (3, 1 << 20), (50, 64)])
def test_equals_brute_force(spark, rows, size):
    for data in (EDGE, random_rows(1)):
        assert run(spark, data, rows=rows, size=size) == brute(data)


def test_blocks_of_any_size_agree(spark):
    """Few different turns: deep shared prefixes cross many block edges."""
    data = random_rows(2, n=300, words=1, turns=9)
    want = brute(data)
    for rows in (2, 7, 64):
        assert run(spark, data, rows=rows) == want


def test_empty_table(spark):
    assert run(spark, EDGE[:1]) == []


def test_turnless_only(spark):
    """Conversations that lose all their turns are members of the root, which is then a leaf."""
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6)
    assert run(spark, [(c, 1, "u", "t")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = catalog.op13_trie(spark, "/root/testdata/sf0.001")
    assert out.columns == COLUMNS and sorted(tuple(r) for r in out.collect()) == brute(rows)


def test_range_minima():
    random_ = np.random.default_rng(3)
    values = random_.integers(-1, 6, 97)
    m = trie.RangeMinima(values)
    lo = random_.integers(0, 97, 500)
    hi = np.minimum(97, lo + random_.integers(1, 97, 500))
    assert m.between(lo, hi).tolist() == [values[a:b].min() for a, b in zip(lo, hi)]
    least = random_.integers(0, 6, 500)
    right = [next((i for i in range(a + 1, 97) if values[i] < d), 97) for a, d in zip(lo, least)]
    left = [next((i for i in range(a, 0, -1) if values[i] < d), 0) for a, d in zip(lo, least)]
    assert m.right(lo, least).tolist() == right and m.left(lo, least).tolist() == left
