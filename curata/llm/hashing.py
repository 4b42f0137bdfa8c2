"""Nearest neighbours by multi-index hashing (operator 4).

Codes: every vector is extended by one coordinate that makes all of them equally long (so
that the largest inner product becomes the smallest angle), turned by learned rotations
(iterative quantization on a bounded sample) and its signs are its bits.  Codes are split
into substrings of 16 bits, and a block of the table indexes each substring in a table of
its own.  By the pigeonhole principle two codes within a Hamming radius agree, in one
substring at least, up to its share of the radius; so probing the tables with all values
that near retrieves every code within the radius.  Where that ball holds more values than
the table has keys, the keys are run through instead.  The retrieved vectors are reranked
by the inner product of the original vectors, in double precision.

The radius is measured on the sample: it covers all but ``MISSED`` of the true neighbours
of sampled queries.  A query that finds fewer than ``k`` codes in a block goes on to the
nearest codes of that block beyond the radius.

The query set meets the table in blocks: each group is one block of queries and one block
of vectors, and returns one row a query.  Lists are merged ``MERGE`` blocks at a time.

Defined results: vectors that are null or zero, hold null or non-finite components or have
not the table's length take no part, nor do rows without id; a query with fewer candidates
than ``k`` gets all of them; ties go to the smaller id; rows that repeat an id are
candidates of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curata.llm.common import arrow_map, runs
from curata.llm.vectors import dimension, doubles, kind, sample, usable

NEIGHBOURS = 20
BITS = 256
SUBSTRING = 16
SAMPLE = 4096
MISSED = 0.02
VECTORS_A_BLOCK, QUERIES_A_BLOCK = 4096, 1024
MERGE = 256


@dataclass
class Codes:
    """Rotations (dim + 1) x BITS, the greatest length, and the Hamming radius."""

    rotations: np.ndarray
    longest: float
    radius: int = 0

    def extended(self, x: np.ndarray, query: bool) -> np.ndarray:
        if query:
            return np.hstack([x, np.zeros((len(x), 1))])
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(1), 0))
        return np.hstack([x, rest[:, None]])

    def encode(self, x: np.ndarray, query: bool) -> np.ndarray:
        """BITS / 16 substrings a vector."""
        bits = self.extended(x, query) @ self.rotations > 0
        return np.packbits(bits, axis=1).view(np.uint16)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances between the codes of a and of b."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    out = np.zeros((len(a), len(b)), np.uint16)
    for w in range(a.shape[1]):
        out += np.bitwise_count(a[:, w][:, None] ^ b[:, w][None, :])
    return out


def rotation(x: np.ndarray, random: np.random.Generator, rounds: int = 15) -> np.ndarray:
    """An orthogonal matrix that brings the rows of x near to the corners of the cube."""
    r = np.linalg.qr(random.standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
        r = (u @ v).T
    return r


def learn(x: np.ndarray, longest: float, total: int, k: int = NEIGHBOURS, missed: float = MISSED) -> Codes:
    """Rotations and radius from sampled vectors x of a table of ``total`` vectors."""
    codes = Codes(np.zeros((x.shape[1] + 1, BITS)), longest)
    e = codes.extended(x, query=False)
    e = e / max(longest, 1e-300)
    random = np.random.default_rng(4)
    parts = [rotation(e, random) for _ in range(math.ceil(BITS / e.shape[1]))]
    codes.rotations = np.hstack(parts)[:, :BITS]
    # neighbours in the sample as near as the k nearest of the whole table: rank scaled, 1 at least
    near = max(1, min(k, len(x) - 1, round(k * len(x) / max(total, 1))))
    asked = x[:: max(1, len(x) // 400)]
    score = asked @ x.T
    score[np.arange(len(asked)), np.arange(0, len(x), max(1, len(x) // 400))] = -np.inf
    best = np.argsort(-score, axis=1)[:, :near]
    far = np.take_along_axis(distances(codes.encode(asked, True), codes.encode(x, False)), best, 1)
    codes.radius = int(np.quantile(far, 1 - missed, method="higher")) if far.size else BITS
    return codes


class Tables:
    """The substring tables of one block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.keys, self.first = [], []
        for t in range(codes.shape[1]):
            keys, first = np.unique(codes[self.order[:, t], t], return_index=True)
            self.keys.append(keys)
            self.first.append(np.append(first, len(codes)))

    def probe(self, asked: np.ndarray, radius: int) -> np.ndarray:
        """Mask queries x rows: every code within the radius (and others that share a near substring)."""
        tables = self.codes.shape[1]
        share, over = divmod(radius, tables)
        found = np.zeros((len(asked), len(self.codes)), bool)
        for t in range(tables):
            r = share if t <= over else share - 1  # pigeonhole: over + 1 tables take the larger share
            if r < 0:
                continue
            keys, first, order = self.keys[t], self.first[t], self.order[:, t]
            if sum(math.comb(SUBSTRING, i) for i in range(r + 1)) < len(keys):
                values = asked[:, t][:, None] ^ ball(r)[None, :]
                at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
                q, v = np.nonzero(keys[at] == values)
                at = at[q, v]
            else:
                q, at = np.nonzero(np.bitwise_count(asked[:, t][:, None] ^ keys[None, :]) <= r)
            size = first[at + 1] - first[at]
            spread = np.repeat(first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            found[np.repeat(q, size), order[spread]] = True
        return found


def ball(radius: int) -> np.ndarray:
    """All 16-bit values of at most ``radius`` one bits."""
    v = np.arange(1 << SUBSTRING, dtype=np.uint16)
    return v[np.bitwise_count(v) <= radius]


def search_block(codes: Codes, k: int, query_rid, queries, rid, ids, x) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of the nearest vectors found in a block for each query."""
    coded = codes.encode(x, query=False)
    tables = Tables(coded)
    out = []
    for lo in range(0, len(queries), 128):
        q = queries[lo:lo + 128]
        asked = codes.encode(q, query=True)
        far = distances(asked, coded)
        own = query_rid[lo:lo + 128][:, None] == rid[None, :]
        found = tables.probe(asked, codes.radius) & (far <= codes.radius) & ~own
        for i in range(len(q)):
            rows = np.flatnonzero(found[i])
            if len(rows) < k:  # beyond the radius, by the nearest codes
                rest = np.flatnonzero(~own[i])
                rows = rest[np.lexsort((ids[rest], far[i, rest]))[:k]] if len(rest) > k else rest
                rows = np.union1d(rows, np.flatnonzero(found[i]))
            score = x[rows] @ q[i]
            best = np.lexsort((ids[rows], -score))[:k]
            out.append((ids[rows[best]], score[best]))
    return out


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, key, score): for the rows whose id is divisible by ``every``, the k nearest found."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    dim, dtype = dimension(rows, "v"), kind(rows, "v")
    staged = usable(rows.where("id is not null").withColumn("rid", F.monotonically_increasing_id()), "id", "v", dim, ("rid",))
    total = staged.count()
    spark = vectors.sparkSession
    if not total:
        return spark.createDataFrame([], f"query_id bigint, rank int, {key} bigint, score double")

    def lengths(batches):
        for b in batches:
            x = doubles(b.column(0), dtype, dim)
            yield pa.RecordBatch.from_arrays([pa.array(np.sqrt((x * x).sum(1)).max(keepdims=True) if len(x) else np.zeros(0))], ["l"])

    longest = arrow_map(staged.select("x"), lengths, "l double").agg(F.max("l")).first()[0]
    codes = learn(sample(staged, SAMPLE, dtype), longest, total, k)
    is_query = F.pmod(F.col("id"), F.lit(every)) == 0
    blocks, parts = -(-total // VECTORS_A_BLOCK), -(-max(1, staged.where(is_query).count()) // QUERIES_A_BLOCK)
    block_of = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    base = staged.select("id", "rid", "x", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), block_of(blocks).alias("block"), F.lit(False).alias("q"))
    asked = staged.where(is_query).select("id", "rid", "x", block_of(parts).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("q"))
    grid = base.unionByName(asked).repartition("block", "part").sortWithinPartitions("block", "part")

    def run(batches):
        for g in runs(batches, ["block", "part"]):
            q = g["q"].to_numpy()
            if not q.any() or q.all():
                continue
            ids, rid, x = g["id"].to_numpy(), g["rid"].to_numpy(), doubles(g["x"], dtype, dim)
            got = search_block(codes, k, rid[q], x[q], rid[~q], ids[~q], x[~q])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid[q]), pa.array(ids[q]), pa.array(np.full(int(q.sum()), g["block"][0].as_py(), np.int32)),
                 pa.array([a.tolist() for a, _ in got], pa.list_(pa.int64())), pa.array([s.tolist() for _, s in got], pa.list_(pa.float64()))],
                ["rid", "id", "block", "ids", "scores"])

    found = arrow_map(grid, run, "rid bigint, id bigint, block int, ids array<bigint>, scores array<double>")
    found = found.select("rid", "id", "block", F.transform(F.arrays_zip("ids", "scores"), lambda z: F.struct((-z["scores"]).alias("s"), z["ids"].alias("i"))).alias("top"))
    while True:
        blocks = -(-blocks // MERGE)
        found = (found.groupBy("rid", "id", F.floor(F.col("block") / MERGE).alias("block"))
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")))
        if blocks == 1:
            break
    return (found.select("id", F.posexplode("top").alias("at", "t"))
            .select(F.col("id").alias("query_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("t.i").alias(key), (-F.col("t.s")).alias("score")))
