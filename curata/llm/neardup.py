"""MinHash near-duplicates with odd sketches (operator 8).

1. Every text becomes its set of hashed shingles.  ``SAMPLES`` MinHash values are taken;
   the first of them, ``ROWS`` a band, form bands, and all of them are folded into a parity
   bitmap of ``BITS`` bits (an odd sketch: every sampled value flips one bit), whose XOR
   population count estimates how many samples two texts do not share.
2. Texts with equal sets are one class, so copies are compared once.
3. Classes that share a band are candidates; inside a bucket the sketches are compared
   pairwise, in blocks of ``BLOCK`` rows (a large bucket becomes many block pairs), and
   pairs of few different bits (``bounds``) are likely links.  A block returns no pairs,
   only which of its classes likely links connect (a star each).  The components of all
   these are the loose groups.
4. Inside a loose group, again in block pairs, every likely link is confirmed on the full
   sets, nearest first, unless confirmed links of the block connect its ends already.  A
   block returns the confirmed links that connected something; their components are the
   result.  So no group emits all its pairs, none is capped, and every likely link is
   confirmed, refuted, or inside one component.

The threshold is an argument, in percent; bands and the most different bits follow from it
(``bounds``): a pair at the threshold shares no band with a probability of at most 8e-7, and
lies beyond the most bits (over six standard deviations) with a still lower one; both fall fast above it.

Defined results: a text without words, a null text and a row without id are linked with
nothing; a text with fewer words than a shingle is one shingle; copies are linked; rows
that repeat an id get the same component; an empty table gives an empty result.  Only the
id and text columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curata.llm.common import arrow_map, runs, small_batches, stage, trimmed
from curata.llm.components import components
from curata.llm.words import LOWER, U, buffers, mix, shingles, span_hashes, split

SHINGLE = 5
#: A link: 100 * intersection >= percent * union; this percent if none is given, with its ``bounds``.
PERCENT = 85
BANDS, ROWS = 24, 5
SAMPLES = 240
BITS = 512
MOST_BITS = 120
#: The chance that a pair at the threshold shares no band, and the standard deviations to the most bits.
MISSED, DEVIATIONS = 8e-7, 6.2
#: Rows of a bucket compared with each other at once.
BLOCK = 256
#: Rows up to which a side of small rows is sent to all executors; beyond, Spark joins by shuffle.
MOST_SENT = 4_000_000
#: Bytes of text hashed at once.
SLICE = 1_500_000

_RANDOM = np.random.default_rng(8)
_XOR = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_MUL = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * U(2) + U(1)


def bounds(percent: int) -> tuple[int, int]:
    """(bands, most different bits of likely links) for a threshold."""
    s = percent / 100
    bands = math.ceil(math.log(MISSED) / math.log1p(-s**ROWS)) if s < 1 else 1
    if not 0 < bands * ROWS <= SAMPLES:
        raise ValueError(f"{percent} % needs {bands} bands of {ROWS}; there are {SAMPLES} samples")
    flips = 2 * SAMPLES * (1 - s)  # a sample that differs flips a bit on either side
    kept, kept2 = (1 - 2 / BITS) ** flips, (1 - 4 / BITS) ** flips
    drawn = 2 * kept * math.sqrt(SAMPLES * s * (1 - s))
    met = max(0.0, BITS / 4 * (1 - kept2) - flips * kept2)  # variance by bits that meet
    return bands, math.ceil(BITS / 2 * (1 - kept) + DEVIATIONS * math.sqrt(drawn**2 + met))


def shingle_sets(column: pa.Array, size: int = SHINGLE):
    """Slices of a text column: (from, hashes sorted within each text, shingles a text)."""
    raw, offsets = buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, side="right")) - 1)
        part = LOWER[raw[offsets[lo]:offsets[hi]]]
        starts, ends, counts = split(part, offsets[lo:hi + 1] - offsets[lo])
        yield lo, *shingles(span_hashes(part, starts, ends), counts, size)
        lo = hi


def signatures(hashes: np.ndarray, counts: np.ndarray, n_bands: int = BANDS):
    """(band keys: texts x n_bands, odd sketches: texts x BITS / 8) of the texts with shingles."""
    at = (np.cumsum(counts) - counts)[counts > 0]
    n = len(at)
    bands = np.zeros((n, n_bands), U)
    bits = np.zeros((n, BITS), np.uint8)
    rows = np.arange(n)
    for i in range(SAMPLES):
        least = np.minimum.reduceat((hashes ^ _XOR[i]) * _MUL[i], at) if n else np.zeros(0, U)
        if i < n_bands * ROWS:
            bands[:, i // ROWS] = bands[:, i // ROWS] * U(0xD6E8FEB86659FD93) + mix(least + U(i))
        bits[rows, (mix(least + U(1000 + i)) >> U(40)) % U(BITS)] ^= 1
    bands = mix(bands + np.arange(n_bands, dtype=U)[None, :])
    return bands, np.packbits(bits, axis=1)


def fingerprints(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify a set together with its size."""
    out = []
    for salt in (U(0x243F6A8885A308D3), U(0x13198A2E03707344)):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(hashes ^ salt))])
        at = np.concatenate([[0], np.cumsum(counts)])
        out.append((sums[at[1:]] - sums[at[:-1]]).view(np.int64))
    return out[0], out[1]


def describe(docs: DataFrame, key: str, text: str, n_bands: int) -> DataFrame:
    """Staged: (id, n, f1, f2, bands array<bigint>, sketch binary) of every row."""
    def run(batches):
        for b in batches:
            for lo, hashes, counts in shingle_sets(b.column(1)):
                bands, sketches = signatures(hashes, counts, n_bands)
                f1, f2 = fingerprints(hashes, counts)
                has = counts > 0
                width = np.where(has, n_bands, 0)
                keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(width)]).astype(np.int32)),
                                                pa.array(bands.reshape(-1).view(np.int64)))
                flat = iter(sketches)
                sketch = pa.array([next(flat).tobytes() if x else b"" for x in has], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(counts)), pa.array(counts.astype(np.int64)), pa.array(f1), pa.array(f2), keys, sketch],
                    ["id", "n", "f1", "f2", "bands", "sketch"])

    return stage(arrow_map(docs.select(docs[key].cast("long").alias("id"), docs[text]), trimmed(run),
                           "id bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>, sketch binary"))


def sent(df: DataFrame, rows: int) -> DataFrame:
    """A hint to send a side of counted, small rows to all executors; a shuffle beyond."""
    return F.broadcast(df) if rows <= MOST_SENT else df


def blocked(rows: DataFrame, group: str, size: str) -> DataFrame:
    """Every group of more than ``BLOCK`` rows as all pairs (x, y) of its blocks; ``side`` is a row's own.

    Dealt out and sorted by (group, x, y): a group of n rows takes n / BLOCK copies of each."""
    m = rows.withColumn("blocks", F.ceil(F.col(size) / BLOCK).cast("int")).withColumn("side", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.withColumn("x", F.least("side", "other")).withColumn("y", F.greatest("side", "other")).drop("blocks", "other", size)
    return m.repartition(group, "x", "y").sortWithinPartitions(group, "x", "y")


def likely(table: pa.Table, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of a block pair that likely are links, nearest first."""
    side, block = table["side"].to_numpy(), (table["x"][0].as_py(), table["y"][0].as_py())
    same = block[0] == block[1]
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), U).reshape(len(side), -1)
    own = np.arange(len(side)) if same else np.flatnonzero(side == block[0])
    other = np.arange(len(side)) if same else np.flatnonzero(side == block[1])
    left, right, near = [], [], []
    for lo in range(0, len(own), 128):
        rows = own[lo:lo + 128]
        far = np.zeros((len(rows), len(other)), np.uint16)
        for w in range(sketch.shape[1]):
            far += np.bitwise_count(sketch[rows, w][:, None] ^ sketch[other, w][None, :])
        ok = far <= most_bits
        if same:
            ok &= rows[:, None] < other[None, :]
        i, j = np.nonzero(ok)
        left.append(rows[i])
        right.append(other[j])
        near.append(far[i, j])
    i, j, far = np.concatenate(left), np.concatenate(right), np.concatenate(near)
    order = np.argsort(far, kind="stable")
    return i[order], j[order]


def connected(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that the pairs connect each of ``n`` rows with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def confirmed(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """The confirmed links among the pairs, in order, that connected what wasn't yet."""
    label, out = np.arange(len(sets)), []
    while len(i):
        a, b = sets[i[0]], sets[j[0]]
        p, q = int(i[0]), int(j[0])
        i, j = i[1:], j[1:]
        both = len(np.intersect1d(a, b, assume_unique=True))
        if 100 * both >= percent * (len(a) + len(b) - both):
            out.append((p, q))
            label[label == label[q]] = label[p]
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
    return out


def loose_links(members: DataFrame, most_bits: int) -> DataFrame:
    """Staged (u, v): stars over the classes of a bucket that likely links connect."""
    def run(batches):
        for group in runs(batches, ["key", "x", "y"]):
            i, j = likely(group, most_bits)
            if len(i):
                c = group["c"].to_numpy()
                label = connected(len(c), i, j)
                rows = np.flatnonzero(label != np.arange(len(c)))
                yield pa.RecordBatch.from_arrays([pa.array(c[rows]), pa.array(c[label[rows]])], ["u", "v"])

    m = blocked(members.select("key", "c", "n", "sketch"), "key", "n")
    return stage(arrow_map(m, trimmed(run), "u bigint, v bigint").where("u <> v").distinct())


def links(groups: DataFrame, percent: int, most_bits: int) -> DataFrame:
    """Staged (u, v): confirmed links that connect the classes of ``groups`` (root, c, n, sketch, shingles)."""
    def run(batches):
        for group in runs(batches, ["root", "x", "y"]):
            i, j = likely(group, most_bits)
            if len(i):
                c = group["c"].to_numpy()
                sets = [np.frombuffer(x.as_buffer(), U) for x in group["shingles"]]
                found = confirmed(sets, i, j, percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[[p for p, _ in found]], pa.int64()), pa.array(c[[q for _, q in found]], pa.int64())], ["u", "v"])

    with small_batches(groups.sparkSession):
        return stage(arrow_map(blocked(groups, "root", "n"), trimmed(run), "u bigint, v bigint"))


def full_sets(docs: DataFrame, wanted: DataFrame, rows: int, key: str, text: str) -> DataFrame:
    """Staged (c, shingles binary) of the classes ``wanted`` (c, id, n, f1, f2), read from a text of each."""
    some = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("t"))
    some = some.join(sent(wanted.select("id"), rows), "id", "left_semi")

    def run(batches):
        for b in batches:
            for lo, hashes, counts in shingle_sets(b.column(1)):
                f1, f2 = fingerprints(hashes, counts)
                edge = np.concatenate([[0], np.cumsum(counts)])
                sets = [hashes[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(f1), pa.array(f2), pa.array(counts.astype(np.int64)), pa.array(sets, pa.binary())],
                                                 ["f1", "f2", "n", "shingles"])

    got = arrow_map(some, trimmed(run), "f1 bigint, f2 bigint, n bigint, shingles binary")
    with small_batches(docs.sparkSession):
        return stage(got.join(sent(wanted.select("c", "f1", "f2", "n"), rows), ["f1", "f2", "n"]).select("c", "shingles"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row: one component of linked texts each."""
    n_bands, most_bits = bounds(percent)
    rows = describe(docs, key, text, n_bands)
    some = rows.where("n > 0 and id is not null")
    classes = stage(some.groupBy("n", "f1", "f2").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
                    .withColumn("c", F.monotonically_increasing_id()))  # written: a class keeps its number
    band = classes.select("c", F.explode("bands").alias("key"))
    shared = band.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = band.join(shared, "key").join(classes.select("c", "sketch"), "c").select("key", "c", "n", "sketch")
    groups = stage(components(loose_links(members, most_bits)).select(F.col("node").alias("c"), "root"))
    # every root stands for itself, too
    groups = groups.union(groups.select(F.col("root").alias("c"), "root").distinct())
    nodes = stage(groups.join(classes.select("c", "id", "n", "f1", "f2", "sketch"), "c"))
    sets = full_sets(docs, nodes, nodes.count(), key, text)
    sizes = nodes.groupBy("root").agg(F.count("*").alias("size"))
    full = nodes.join(sizes, "root").join(sets, "c").select("root", "c", F.col("size").alias("n"), "sketch", "shingles")
    roots = components(links(full, percent, most_bits))
    comp = nodes.select("c").join(roots, nodes["c"] == roots["node"], "left").select("c", F.coalesce("root", "c").alias("comp"))
    # every class of a component gets the least id of all its classes
    named = nodes.select("c", "id").join(comp, "c")
    least = named.groupBy("comp").agg(F.min("id").alias("least"))
    named = named.join(least, "comp").select("c", "least")
    final = classes.select("c", "id", "n", "f1", "f2").join(named, "c", "left").select("n", "f1", "f2", F.coalesce("least", "id").alias("component"))
    out = rows.select("id", "n", "f1", "f2").join(final, ["n", "f1", "f2"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the text with the least id."""
    gone = stage(near_duplicates(docs, key, text, percent).where("not kept and component_id is not null").select(key))
    rows = gone.count()
    return docs.join(sent(gone, rows), key, "left_anti").select(*docs.columns)


def oracle(percent: int = PERCENT) -> str:
    """DuckDB SQL for ``near_duplicates`` over documents with different ids: shares all pairs, so for small tables."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w FROM documents),
      s AS (SELECT doc_id, CASE WHEN len(w) >= {SHINGLE} THEN list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}),
        lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
      u AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM s),
      p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.sh = b.sh AND a.doc_id < b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
      e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
      r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
      c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
      SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)"""
