"""Embedding near-duplicates by a pivot-permutation index (operator 7).

Every vector is described by its ``NEAREST`` nearest pivots, in order; pivots are vectors of the
table, no two of them closer than ``SPREAD``, so that a dense group owns few of them however
many rows it has.  A vector is posted under each of its pivots in the inverted list of (group,
pivot).  Inside a list, vectors that share at least ``SHARED`` pivots, or one to which both are
closer than ``SPREAD``, are candidates; a pair is taken up only in the list of the first pivot,
in number, that both share, so it is counted once.  The cosine of the candidates' full vectors,
in double precision, decides.

A list of more than ``BLOCK`` rows is compared as many block pairs, in as many groups.  No
pair leaves its task: a task returns how many links each vector has and, for the
components, only the edges of a spanning forest.  Equal vectors of a group are one class.

Defined results: a vector that is null or zero, holds null or non-finite components, has
not the table's length, or has no group, links with nothing; so does a row without id
(component null).  Rows that repeat an id count as two vectors.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curata.llm.common import arrow_map, runs, stage
from curata.llm.components import components
from curata.llm.vectors import dimension, doubles, kind, sample, unpack, usable

THRESHOLD = 0.93
NEAREST, SHARED = 12, 3
LEAST_PIVOTS, MOST_PIVOTS = 256, 1024
#: Pivots have a lower cosine with each other; they are picked from so many vectors for each.
SPREAD, PICKED_FROM = 0.8, 4
BLOCK = 512


def pivot_count(rows: int) -> int:
    """Pivots for a table: with the square root of its rows, so that lists grow as slowly; a multiple of 64."""
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, 64 * math.ceil(math.sqrt(rows) / 64)))


def spread(vectors: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the vectors, the first ones whose cosine with all before is under ``SPREAD``."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    taken: list[int] = []
    near = np.full(len(unit), -1.0)
    for i in range(len(unit)):
        if near[i] < SPREAD:
            taken.append(i)
            if len(taken) == most:
                break
            near = np.maximum(near, unit @ unit[i])
    return vectors[taken]


def draw(classes: DataFrame, total: int, dtype: np.dtype) -> np.ndarray:
    """The pivots of a table of ``total`` classes."""
    most = pivot_count(total)
    share = min(1.0, 2 * PICKED_FROM * most / max(total, 1))
    some = classes.where(F.pmod(F.xxhash64("x", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = sample(some, PICKED_FROM * most, dtype)
    return spread(found, most) if len(found) else found


def post(staged: DataFrame, pivots: np.ndarray, dtype: np.dtype) -> DataFrame:
    """(c, grp, size, pivot, mask, x): a row for each vector and each of its nearest pivots.

    The first half of ``mask`` says which pivots these are, the second which of them are closer than ``SPREAD``."""
    unit = pivots / np.linalg.norm(pivots, axis=1, keepdims=True)
    nearest, words = min(NEAREST, len(unit)), -(-len(unit) // 64)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                x = doubles(part.column(3), dtype, unit.shape[1])
                cosine = x @ unit.T / np.linalg.norm(x, axis=1, keepdims=True)
                own = np.argsort(-cosine, axis=1, kind="stable")[:, :nearest]
                mask, at = np.zeros((len(x), 2 * words), np.uint64), np.arange(len(x))
                for k in range(nearest):
                    bit = np.uint64(1) << (own[:, k] % 64).astype(np.uint64)
                    mask[at, own[:, k] // 64] |= bit
                    mask[at, words + own[:, k] // 64] |= np.where(cosine[at, own[:, k]] >= SPREAD, bit, np.uint64(0))
                masks = pa.array([m.tobytes() for m in mask], pa.binary())
                at = pa.array(np.repeat(np.arange(len(x)), nearest))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), part.column(2).take(at), pa.array(own.reshape(-1)),
                     masks.take(at), part.column(3).take(at)], ["c", "grp", "size", "pivot", "mask", "x"])

    return arrow_map(staged.select("c", "grp", "size", "x"), run,
                     "c bigint, grp bigint, size bigint, pivot bigint, mask binary, x binary")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """The edges of a spanning forest of the links."""
    parent: dict[int, int] = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    out = []
    for u, v in zip(a.tolist(), b.tolist()):
        p, q = find(u), find(v)
        if p != q:
            parent[q] = p
            out.append((u, v))
    return out


def links(t: pa.Table, pivot: int, block: tuple[int, int], need: int, dim: int, dtype: np.dtype, threshold: float):
    """Within one list or block pair: (class, linked vectors) counts and forest edges."""
    c, size, side = t["c"].to_numpy(), t["size"].to_numpy(), t["side"].to_numpy()
    mask = unpack(t["mask"], np.uint64, len(t["mask"][0].as_py()) // 8)
    x = doubles(t["x"], dtype, dim)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    same = block[0] == block[1]
    own = np.arange(len(c)) if same else np.flatnonzero(side == block[0])
    other = np.arange(len(c)) if same else np.flatnonzero(side == block[1])
    words = mask.shape[1] // 2
    word, bit = divmod(pivot, 64)
    found = np.zeros(len(c), np.int64)
    a, b = [], []
    for lo in range(0, len(own), 256):
        rows = own[lo:lo + 256]
        shared = np.zeros((len(rows), len(other)), np.uint16)
        earlier = np.zeros((len(rows), len(other)), bool)  # a pivot before this one is shared, too
        close = np.zeros((len(rows), len(other)), bool)
        for w in range(words):
            both = mask[rows, w][:, None] & mask[other, w][None, :]
            shared += np.bitwise_count(both)
            if w < word:
                earlier |= both != 0
            elif w == word:
                earlier |= (both & np.uint64((1 << bit) - 1)) != 0
            if mask[rows, words + w].any():
                close |= (mask[rows, words + w][:, None] & mask[other, words + w][None, :]) != 0
        ok = ((shared >= need) | close) & ~earlier
        if same:
            ok &= rows[:, None] < other[None, :]
        i, j = np.nonzero(ok)
        i, j = rows[i], other[j]
        linked = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
        i, j = i[linked], j[linked]
        np.add.at(found, i, size[j])
        np.add.at(found, j, size[i])
        a.append(i)
        b.append(j)
    a, b = np.concatenate(a), np.concatenate(b)
    some = np.flatnonzero(found)
    edges = _forest(c[a], c[b])
    return c[some], found[some], edges


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", group: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; ``group`` is an integer column."""
    every = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.col(group).cast("long").alias("grp"))
    dim = dimension(every, "v")
    rows = usable(every.where("grp is not null and id is not null"), "id", "v", dim, ("grp",))
    rows = rows.withColumn("c", F.xxhash64("grp", "x"))
    classes = stage(rows.groupBy("c", "grp", "x").agg(F.min("id").alias("id"), F.count("*").alias("size")))
    total, dtype = classes.count(), kind(every, "v")
    pivots = draw(classes, total, dtype)
    need = min(SHARED, len(pivots))
    lists = post(classes, pivots, dtype) if len(pivots) else None
    if lists is None:
        found = named = None
    else:
        sizes = lists.groupBy("grp", "pivot").agg(F.count("*").alias("n")).where("n > 1")
        few = sizes.count()  # at most groups times pivots
        p = lists.join(F.broadcast(sizes) if few <= 1_000_000 else sizes, ["grp", "pivot"])
        p = p.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("side", F.pmod(F.col("c"), F.col("blocks")).cast("int"))
        p = p.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        p = p.select("grp", "pivot", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "c", "size", "mask", "x")
        p = p.repartition("grp", "pivot", "lo", "hi").sortWithinPartitions("grp", "pivot", "lo", "hi")

        def run(batches):
            for g in runs(batches, ["grp", "pivot", "lo", "hi"]):
                c, n, edges = links(g, g["pivot"][0].as_py(), (g["lo"][0].as_py(), g["hi"][0].as_py()), need, dim, dtype, threshold)
                u, v = [e[0] for e in edges], [e[1] for e in edges]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*c.tolist(), *u], pa.int64()), pa.array([*n.tolist(), *[None] * len(u)], pa.int64()),
                     pa.array([*[None] * len(c), *v], pa.int64())], ["u", "n", "v"])

        got = stage(arrow_map(p, run, "u bigint, n bigint, v bigint"))
        found = got.where("n is not null").groupBy(F.col("u").alias("c")).agg(F.sum("n").alias("n"))
        named = components(got.where("v is not null").select("u", "v"))
    described = classes.select("c", "id", "size")
    if found is not None:
        described = (described.join(found, "c", "left").join(named, F.col("c") == named["node"], "left")
                     .select("c", "id", "size", "n", F.coalesce("root", "c").alias("comp")))
        least = described.groupBy("comp").agg(F.min("id").alias("least"))
        described = described.join(least, "comp")
    else:
        described = described.select("c", "size", F.lit(None).cast("long").alias("n"), F.col("id").alias("least"))
    described = described.select("c", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "least")
    part = rows.select("id", "c").join(described, "c").select("id", "n_links", "least")
    # rows that take no part: the rest, told by their number of rows an id
    taken = part.withColumn("nth", F.lit(1))
    rest = every.select("id", F.lit(1).alias("one")).groupBy("id").agg(F.count("*").alias("rows"))
    gone = (rest.join(part.groupBy(F.col("id").alias("p")).agg(F.count("*").alias("used")), F.col("id") == F.col("p"), "left")
            .withColumn("left_over", F.col("rows") - F.coalesce("used", F.lit(0))).where("left_over > 0")
            .select("id", F.explode(F.sequence(F.lit(1), F.col("left_over"))).alias("nth"))
            .select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("least")))
    out = taken.select("id", "n_links", "least").union(gone)
    return out.select(F.col("id").alias(key), "n_links", F.col("least").alias("component_id"),
                      F.coalesce(F.col("least") == F.col("id"), F.lit(False)).alias("kept"))


def oracle(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``near_duplicates`` over embeddings with different ids: all pairs of a label, so for small tables."""
    return f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
      ok AS (SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        AND list_dot_product(x, x) > 0),
      p AS (SELECT a.vec_id AS i, b.vec_id AS j FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
        WHERE list_dot_product(a.x, b.x) >= {threshold} * sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))),
      r AS (SELECT vec_id AS i, vec_id AS j FROM v UNION SELECT r.i, p.j FROM r JOIN p ON p.i = r.j),
      c AS (SELECT i, min(j) AS component_id FROM r GROUP BY i),
      n AS (SELECT i, count(*) AS n FROM p GROUP BY i)
      SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
      FROM v JOIN c ON c.i = vec_id LEFT JOIN n ON n.i = vec_id"""
