"""Near-duplicates, vectors, quality: brute-force versions and edge cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curata.llm import components, hashing, neardup, pivots, quality


# ------------------------------------------------------------------ components
@pytest.mark.parametrize("hub", [2048, 5])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "HUB", hub)  # with 5, most stars are split
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    least = {x: x for e in edges for x in e}
    for _ in least:
        for u, v in edges:
            least[u] = least[v] = min(least[u], least[v])
    assert {k: v for k, v in least.items() if k != v} == got
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_take_few_tasks(spark, tmp):
    """The driver keeps every task: where partitions aren't put together, a star step is an aggregate and a join."""
    spark.range(3000).selectExpr("id * 3 + 1 as u", "id * 3 as v").write.parquet(f"{tmp}/edges")
    edges, tracker, keys = spark.read.parquet(f"{tmp}/edges"), spark.sparkContext.statusTracker(), {
        "spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        spark.sparkContext.setJobGroup("few-tasks", "")
        assert components.components(edges).count() == 3000
        stages = {s for j in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 40 < tasks <= 220, tasks


# ------------------------------------------------------------------ MinHash (8)
def word_sets(rows):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4))
    return out


def brute_components(rows, percent=85):
    sets = word_sets(rows)
    least = {i: i for i in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x
    own = sorted(i for i in sets if sets[i])
    for k, a in enumerate(own):
        for b in own[:k]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                least[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, n, size, changes):
    random.seed(seed)
    base = [f"w{random.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(random.randint(0, changes)):
            t[random.randrange(size)] = f"x{random.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_minhash_equals_brute_force(spark):
    texts = near_copies(1, 120, 150, 7) + near_copies(2, 60, 60, 2) + near_copies(3, 40, 400, 25) + ["a b", "A  b", "a b c d e", "a\tb\nc d E", "", None, "  ", "one"] * 2
    texts += [" ".join(f"u{i}_{j}" for j in range(30)) for i in range(50)] + ["copy of this very text here"] * 30 + ["long " * 30000]
    random.seed(9)
    random.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("c", F.lit("clash")).withColumn("key", F.lit(1)).repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    want = brute_components(rows)
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}
    kept = sorted(r.doc_id for r in neardup.keep_one(df).collect())
    assert kept == sorted(i for i, (n, c) in want.items() if c == i)
    assert neardup.keep_one(df).columns == df.columns


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = list(enumerate(near_copies(5, 200, 120, 9)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_minhash_edge_tables(spark):
    schema = "doc_id long, text string"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (4, None)], schema)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(odd).collect())
    assert got == {(None, 1, None, False): 2, (3, 1, 3, True): 2, (4, 0, 4, True): 1}


def test_odd_sketch_bound():
    """Pairs at the threshold lie within MOST_BITS, unrelated ones don't."""
    rng = np.random.default_rng(0)
    near, far = [], []
    for _ in range(60):
        common = rng.integers(1, 1 << 63, 850, dtype=np.uint64)
        a, b = (np.sort(np.concatenate([common, rng.integers(1, 1 << 63, 75, dtype=np.uint64)])) for _ in range(2))
        sets = [a, b, rng.integers(1, 1 << 63, 900, dtype=np.uint64)]
        _, s = neardup.signatures(np.concatenate(sets), np.array([len(x) for x in sets]))
        bits = np.unpackbits(s, axis=1)
        near.append((bits[0] != bits[1]).sum())
        far.append((bits[0] != bits[2]).sum())
    assert max(near) <= neardup.MOST_BITS < min(far)


# ------------------------------------------------------------------ vectors (4, 7)
ODD = [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [1.0] * 3, [None] + [1.0] * 7]


def vectors(seed=0, n=600, dim=8):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[100:160] = x[100] + 0.1 * rng.standard_normal((60, dim))  # near copies, many partly linked
    x[200:230] = x[200]                                         # copies
    x[300] = 2 * x[301]
    return x.astype(np.float32)


def test_pivots_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 32)
    x = vectors()
    label = np.arange(len(x)) // 150
    rows = [(i, v.tolist(), int(g)) for i, (v, g) in enumerate(zip(x, label))]
    rows += [(1000 + i, v, 1) for i, v in enumerate(ODD)] + [(2000, x[0].tolist(), None), (None, x[1].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("c", F.lit("clash")).repartition(4)
    got = {r.vec_id: r for r in pivots.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= linked.sum(1)).all() and found.sum() >= 0.99 * linked.sum()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(1000, 1006)) and got[2000].n_links == 0
    assert not got[None].kept and got[None].component_id is None
    for i in range(200, 230):
        assert got[i].component_id <= 200 and got[i].n_links >= 29
    assert pivots.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("least, cosine", [(256, 0.95), (1024, 0.93)])
def test_pivots_in_a_group_of_a_third(spark, monkeypatch, least, cosine):
    """A dense group with a third of all rows, in one label, with few and with the most pivots."""
    monkeypatch.setattr(pivots, "LEAST_PIVOTS", least)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4500, 64))
    x[:1500] = x[0] / np.linalg.norm(x[0]) + np.sqrt((1 / cosine - 1) / 64) * x[:1500]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(4)
    got = {r.vec_id: r.n_links for r in pivots.near_duplicates(df).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93).sum(1) - 1
    found = np.array([got[i] for i in range(len(x))])
    assert linked.sum() > 500_000 and (found <= linked).all()
    assert found.sum() >= 0.9999 * linked.sum()


def test_hashing_recall_and_edges(spark, monkeypatch):
    monkeypatch.setattr(hashing, "VECTORS_A_BLOCK", 100)
    monkeypatch.setattr(hashing, "MERGE", 2)
    x = vectors(1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + 20 * i, v) for i, v in enumerate(ODD)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0)).repartition(4)
    got = collections.defaultdict(list)
    for r in hashing.nearest(df).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 20))
    hits = 0
    d = x.astype(float)
    for q, found in got.items():
        found.sort()
        score = d @ d[q]
        best = [i for i in np.lexsort((np.arange(len(d)), -score)) if i != q][:20]
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [s for _, _, s in found] == pytest.approx([score[i] for _, i, _ in found], abs=1e-12)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len(set(best) & {i for _, i, _ in found})
    assert hits >= 0.9 * 20 * len(got)
    few = hashing.nearest(df.where("vec_id < 5"))
    assert [(r.query_id, r.rank) for r in few.orderBy("rank").collect()] == [(0, k) for k in range(1, 5)]
    assert hashing.nearest(df.limit(0)).count() == 0


def test_pigeonhole_probing():
    """Every code within the radius is retrieved, whether balls or keys are run through."""
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 16, (500, 16), dtype=np.uint16)
    asked = codes[:40].copy()
    for row in asked:  # flip up to 30 bits
        for b in rng.integers(0, 256, 30):
            row[b // 16] ^= np.uint16(1 << (b % 16))
    t = hashing.Tables(codes)
    for radius in (0, 10, 30, 60, 100):
        near = hashing.distances(asked, codes) <= radius
        assert not (near & ~t.probe(asked, radius)).any()


# ------------------------------------------------------------------ quality (10)
def kneser_ney(texts, order=5):
    count = {k: collections.Counter() for k in range(1, order + 1)}
    for t in texts:
        s = b"\2" * (order - 1) + t.encode() + b"\3"
        for i in range(order - 1, len(s)):
            count[order][s[i - order + 1:i + 1]] += 1
    for k in range(order - 1, 0, -1):
        for g in count[k + 1]:
            count[k][g[1:]] += 1
    discount, context = {}, {}
    for k, c in count.items():
        n = collections.Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        raw = (1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5)
        discount[k] = [d if 0 < d < i + 1 else u for i, (d, u) in enumerate(zip(raw, (0.5, 1.0, 1.5)))]
        context[k] = collections.defaultdict(lambda: [0, 0.0])
        for g, m in c.items():
            context[k][g[:-1]][0] += m
            context[k][g[:-1]][1] += discount[k][min(m, 3) - 1]

    def p(g):
        if not g:
            return 1 / 257
        k = len(g)
        if g[:-1] not in context[k]:
            return p(g[1:])
        total, freed = context[k][g[:-1]]
        m = count[k].get(g, 0)
        return ((m - discount[k][min(m, 3) - 1] if m else 0) + freed * p(g[1:])) / total

    def perplexity(t):
        s = b"\2" * (order - 1) + (t or "").encode() + b"\3"
        return math.exp(-sum(math.log(p(s[i - order + 1:i + 1])) for i in range(order - 1, len(s))) / (len(s) - order + 1))
    return perplexity


@pytest.mark.parametrize("hot", [1 << 18, 64])
def test_perplexity_equals_brute_force(spark, monkeypatch, hot):
    """The same with all runs in the map and with most of them joined."""
    monkeypatch.setattr(quality, "HOT", hot)
    monkeypatch.setattr(quality, "BLOOM_BITS", 1 << 14)
    random.seed(4)
    syllables = ["the", "er", "on", "ing", "é", "an", " ", " ", ". ", "of"]
    rows = [(i, "".join(random.choice(syllables) for _ in range(random.randint(0, 80))), random.choice(["en", "fr", None])) for i in range(200)]
    rows += [(500, None, "en"), (501, "", "en"), (502, "ZZ@@\x00" * 50, "de"), (503, "the of " * 8000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("key", F.lit("clash")).repartition(4)
    trusted = spark.createDataFrame([(i,) for i in range(120)] + [(None,), (5,)], "doc_id long")
    got = {r.doc_id: r for r in quality.judge(df, trusted).collect()}
    assert len(got) == len(rows)
    perplexity = kneser_ney([t for i, t, _ in rows if i < 120 and zlib.crc32(str(i).encode()) % 2 == 0])
    for i, t, lang in rows:
        if i != 503:
            assert got[i].perplexity == pytest.approx(perplexity(t), rel=1e-9), i
        assert got[i].kept == (got[i].perplexity <= got[i].threshold)
    assert not got[502].kept
    kept = {r.doc_id for r in quality.keep_good(df, trusted).collect()}
    assert kept == {i for i in got if got[i].kept} and quality.keep_good(df, trusted).columns == df.columns


def test_quality_without_trusted_texts(spark):
    df = spark.createDataFrame([(1, "a", "en"), (2, None, None)], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long")
    assert [(r.perplexity, r.kept) for r in quality.judge(df, none).collect()] == [(None, True)] * 2
    assert quality.judge(df.limit(0), none).count() == 0
