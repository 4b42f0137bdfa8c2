"""Conversation prefix trie by sparse-table range minima over sorted prefixes (operator 13).

A node of the trie is a distinct sequence of first turns; its members are the conversations
that begin with it.  In sorted order the members of a node stand next to each other:

1. a turn becomes 16 bytes (SHA-256 of role and text, cut) and its code points; a conversation
   becomes its turns' bytes one after another, its *key*.  Texts are never moved;
2. conversations are range-partitioned and sorted on (key, id), so that a very common
   conversation spreads over many tasks, and packed into blocks of at most ``ROWS``
   conversations or about ``BYTES`` of keys;
3. ``lcp[j]`` is the number of turns that a conversation shares with the one before it.  A
   block builds sparse tables of range minima over ``lcp`` and over the ids.  A candidate
   prefix of ``d`` turns binary-searches its right extent, and that of its parent's ``d - 1``
   turns its left extent, each by itself: the interval ends where a minimum falls below
   ``d``.  Members, smallest member, children, leaves and saved tokens are differences of
   prefix sums over the interval;
4. a node that runs over a block's edge is a prefix of the block's first or last
   conversation, so a block has few of them.  Their parts are summed up by node, and only
   nodes right below them look their parent up, by block and node.

Saved tokens of a subtree: the code points that each member shares with the one before it,
less those of the turns above the node, a count of members less one times.

The digest of a node's ending members needs their ids one after another in one stream.  Equal
conversations are sorted by id, so their ids come in pieces of ``PIECE`` ids, and a node's
pieces run through one task, row by row; that is the one thing here that doesn't split.

Limits: a conversation is one row of about 24 bytes a turn while it is sorted.

Defined results: rows without conversation id take no part; turns come in order of ``turn``
(null first), ties by role and then by the digest of role and text; a null role or text is
empty; repeated rows are turns of their own; remainders are SQL's (of the sign of the id);
a conversation without turns after rebuilding is a member of the root; an empty table has
no nodes.  Only the four columns named are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from curata.llm.common import arrow_map, stage

#: Bytes a turn has in a key.
TURN = 16
#: Conversations and bytes of keys in a block, at most (one conversation at least).
ROWS, BYTES = 1 << 16, 4 << 20
#: Bytes of keys and counts in a range partition, about.
PARTITION_BYTES = 64 << 20
#: Ids of ending members in a row.
PIECE = 128
#: Rebuilding: conversations in a row share the first turns of the first of them.
FAMILY, SHARED = 100, 6
_NODE = ("row int, part int, nth int, key binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved bigint, above bigint, ends string, piece bigint")
INNER, EDGE, ENDS = 0, 1, 2


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, turns array<struct<d, n>>): a row a conversation, its turns' digests (hex) and code points in order."""
    r, t = F.coalesce(rows[role].cast("string"), F.lit("")), F.coalesce(rows[text].cast("string"), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256), 1, 2 * TURN)
    own = rows.select(rows[conv].cast("long").alias("c"), F.struct(
        rows[turn].isNotNull().alias("known"), rows[turn].alias("turn"), r.alias("role"), digest.alias("d"), F.length(t).cast("long").alias("n")).alias("t"))
    return (own.where("c is not null").groupBy("c").agg(F.array_sort(F.collect_list("t")).alias("t"))
            .select("c", F.transform("t", lambda x: F.struct(x["d"].alias("d"), x["n"].alias("n"))).alias("turns")))


def rebuilt(whole: DataFrame) -> DataFrame:
    """Conversations whose first ``crc32(id) % SHARED`` turns are those of their family's first one.

    At most ``FAMILY`` conversations join with one head of ``SHARED - 1`` turns."""
    whole = stage(whole)
    heads = whole.where(F.col("c") % FAMILY == 0).select(F.col("c").alias("first"), F.slice("turns", 1, SHARED - 1).alias("head"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % SHARED).cast("int")
    none = F.lit([]).cast(whole.schema["turns"].dataType)
    both = whole.join(heads, F.col("c") - F.col("c") % FAMILY == F.col("first"), "left").withColumn("h", h)
    return both.select("c", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                     F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def blocks(whole: DataFrame, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """Staged blocks of sorted conversations: (part, nth, convs, lengths, keys, chars, first_key, last_key)."""
    flat = stage(whole.select("c", F.unhex(F.array_join("turns.d", "")).alias("key"), F.col("turns.n").alias("chars")))
    total = flat.agg(F.sum(F.length("key") + 8 * F.size("chars") + 16)).first()[0] or 0
    parts = max(int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_BYTES))
    laid = flat.repartitionByRange(parts, "key", "c").sortWithinPartitions("key", "c")

    def run(batches):
        part, nth = TaskContext.get().partitionId(), 0
        convs, keys, chars, held = [], [], [], 0

        def block():
            ids, lengths = np.concatenate(convs).astype(np.int64), np.array([len(k) // TURN for k in keys], np.int64)
            n = np.concatenate(chars) if chars else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([nth], pa.int32()),
                 *[pa.array([x], pa.binary()) for x in (ids.tobytes(), lengths.tobytes(), b"".join(keys), n.astype(np.int64).tobytes(), keys[0], keys[-1])]],
                ["part", "nth", "convs", "lengths", "keys", "chars", "first_key", "last_key"])

        for b in batches:
            c, k, n = b.column(0).to_numpy(), b.column(1).to_pylist(), b.column(2)
            at, flat_n = n.offsets.to_numpy(), n.values.to_numpy(zero_copy_only=False)
            for i in range(len(c)):
                if keys and (len(keys) >= rows or held + len(k[i]) > size):
                    yield block()
                    nth += 1
                    convs, keys, chars, held = [], [], [], 0
                convs.append(c[i:i + 1])
                keys.append(k[i])
                chars.append(flat_n[at[i]:at[i + 1]].copy())
                held += len(k[i])
        if keys:
            yield block()

    return stage(arrow_map(laid, run, "part int, nth int, convs binary, lengths binary, keys binary, chars binary, first_key binary, last_key binary"))


def shared_turns(a: bytes | None, b: bytes | None) -> int:
    """Turns with which both keys begin; -1 if one is missing."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // TURN
    same = (np.frombuffer(a, np.uint64, 2 * n) == np.frombuffer(b, np.uint64, 2 * n)).reshape(n, 2).all(1)
    return int(n if same.all() else np.argmin(same))


def edges(packed: DataFrame) -> DataFrame:
    """(part, nth, before, after): turns that a block's first and last conversation share with the neighbour beyond.

    The window holds a row a block, two keys each: a small part of the keys."""
    def run(batches):
        for b in batches:
            part, nth, before, first, last, after = (b.column(i).to_pylist() for i in range(6))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([shared_turns(x, y) for x, y in zip(before, first)], pa.int64()),
                                              pa.array([shared_turns(x, y) for x, y in zip(last, after)], pa.int64())], ["part", "nth", "before", "after"])

    order = Window.orderBy("part", "nth")
    near = packed.select("part", "nth", F.lag("last_key").over(order).alias("before"), "first_key", "last_key", F.lead("first_key").over(order).alias("after"))
    return arrow_map(near, run, "part int, nth int, before bigint, after bigint")


class RangeMinima:
    """Sparse table: minima of all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def between(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least of values[lo:hi] (hi > lo) of every range."""
        out = np.empty(len(lo), self.levels[0].dtype)
        level = np.frexp(hi - lo)[1] - 1
        for k, table in enumerate(self.levels):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k)])
        return out

    def right(self, row: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place after ``row`` with a value below ``least`` (the length if there is none)."""
        n, at = len(self.levels[0]), row + 1
        for k in reversed(range(len(self.levels))):
            table = self.levels[k]
            ok = (at + (1 << k) <= n) & (table[np.minimum(at, len(table) - 1)] >= least)
            at = at + np.where(ok, 1 << k, 0)
        return at

    def left(self, row: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place up to ``row`` with a value below ``least``, or 0: values from there on to ``row`` aren't."""
        at = row.copy()
        for k in reversed(range(len(self.levels))):
            table = self.levels[k]
            ok = (at >= 1 << k) & (table[np.maximum(at - (1 << k) + 1, 0).clip(max=len(table) - 1)] >= least)
            at = at - np.where(ok, 1 << k, 0)
        return at


def common(turns: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Turns that each conversation shares with the one before it (none for the first)."""
    out = np.zeros(len(lengths), np.int64)
    most = np.minimum(lengths[:-1], lengths[1:])
    some = np.flatnonzero(most)
    if len(some):
        size = most[some]
        first = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(first, size)
        same = (turns[np.repeat(at[some], size) + step] == turns[np.repeat(at[some + 1], size) + step]).all(1)
        out[some + 1] = np.minimum.reduceat(np.where(same, np.repeat(size, size), step), first)
    return out


def prefix_digests(key: bytes, depth: int) -> list[bytes]:
    """Names of the nodes of 0 to ``depth`` first turns."""
    h = hashlib.sha256()
    out = [h.digest()[:TURN]]
    for d in range(depth):
        h.update(key[TURN * d:TURN * (d + 1)])
        out.append(h.copy().digest()[:TURN])
    return out


def block_nodes(part: int, nth: int, ids: np.ndarray, lengths: np.ndarray, key: bytes, chars: np.ndarray, before: int, after: int):
    """Batches of a block's nodes: whole ones, parts of those that run over its edges, and their ending members."""
    n, at = len(ids), np.concatenate([[0], np.cumsum(lengths)])
    lcp = common(np.frombuffer(key, np.uint64).reshape(-1, 2), at[:-1], lengths)
    lcp[0] = before
    until = np.append(lcp[1:], after)  # shared with the next one
    minima, least = RangeMinima(lcp), RangeMinima(ids)
    # candidates: the first conversation of every prefix, and all prefixes of the block's first one
    start = np.maximum(lcp + 1, 0)
    start[0] = 0
    count = lengths + 1 - start
    first = np.cumsum(count) - count
    row = np.repeat(np.arange(n), count)
    depth = np.arange(count.sum()) - np.repeat(first, count) + start[row]
    stop = minima.right(row, depth)
    entered = (row == 0) & (depth <= before)
    open_ = entered | ((stop == n) & (depth <= after))
    above_row = minima.left(row, depth - 1)
    above = np.where(depth > 0, first[above_row] + depth - 1 - start[above_row], 0)

    sums = np.concatenate([[0], np.cumsum(chars)])
    shared = sums[at[:-1] + np.maximum(lcp, 0)] - sums[at[:-1]]
    saved = np.concatenate([[0], np.cumsum(shared)])
    leaves = np.concatenate([[0], np.cumsum(until < lengths)])
    total = saved[stop] - saved[row + ~entered]
    over = sums[at[row] + np.maximum(depth - 1, 0)] - sums[at[row]]
    children = np.bincount(above[(depth > 0) & ~entered], minlength=len(row))
    smallest, size = least.between(row, stop), stop - row

    # ending members: runs of equal conversations; a run's node is its first one's last candidate
    begins = np.append(np.flatnonzero(np.append(True, (lcp[1:] != lengths[1:]) | (lengths[1:] != lengths[:-1]))), n)
    ends = np.full(len(row), None, dtype=object)
    pieces = []
    for lo, hi in zip(begins[:-1].tolist(), begins[1:].tolist()):
        node = int(first[lo] + count[lo] - 1)
        if open_[node]:
            pieces.append((node, lo, hi))
        else:
            ends[node] = hashlib.sha256(",".join(map(str, ids[lo:hi].tolist())).encode()).hexdigest()

    crossing = np.flatnonzero(open_)
    names: dict[int, bytes] = {}
    if len(crossing):
        most = int(depth[crossing].max())
        of_first = prefix_digests(key[:TURN * min(most, int(lengths[0]))], min(most, int(lengths[0])))
        of_last = prefix_digests(key[TURN * at[n - 1]:][:TURN * min(most, int(lengths[-1]))], min(most, int(lengths[-1])))
        for i in crossing.tolist():  # a prefix of the block's first or last conversation
            names[i] = (of_first if row[i] == 0 and depth[i] < len(of_first) else of_last)[depth[i]]

    def out(kind, at_, **columns):
        m = len(at_)
        given = {"row": pa.array(np.full(m, kind, np.int32)), "part": pa.array(np.full(m, part, np.int32)), "nth": pa.array(np.full(m, nth, np.int32))} | columns
        types = {"key": pa.binary(), "parent": pa.binary(), "ends": pa.string()}
        fields = [f.split(" ")[0] for f in _NODE.split(", ")]
        return pa.RecordBatch.from_arrays([given.get(f, pa.nulls(m, types.get(f, pa.int64()))) for f in fields], fields)

    parent_of = lambda x: pa.array([names.get(int(above[i])) if depth[i] else None for i in x], pa.binary())
    numbers = lambda x: {"conv_id": pa.array(smallest[x]), "depth": pa.array(depth[x]), "n_convs": pa.array(size[x]),
                         "n_children": pa.array(children[x]), "n_leaves": pa.array(leaves[stop[x]] - leaves[row[x]])}
    whole = np.flatnonzero(~open_)
    for lo in range(0, len(whole), 10_000):
        x = whole[lo:lo + 10_000]
        known = (depth[x] > 0) & ~open_[above[x]]
        yield out(INNER, x, parent=parent_of(x), parent_conv_id=pa.array(smallest[above[x]], mask=~known),
                  saved=pa.array(total[x] - (size[x] - 1) * over[x]), ends=pa.array(ends[x].tolist(), pa.string()), **numbers(x))
    if len(crossing):
        yield out(EDGE, crossing, key=pa.array([names[i] for i in crossing.tolist()], pa.binary()), parent=parent_of(crossing),
                  saved=pa.array(total[crossing]), above=pa.array(over[crossing]), **numbers(crossing))
    for node, lo, hi in pieces:
        at_ = list(range(lo, hi, PIECE))
        for p in range(0, len(at_), 1000):
            some = at_[p:p + 1000]
            yield out(ENDS, some, key=pa.array([names[node]] * len(some), pa.binary()), piece=pa.array([(x - lo) // PIECE for x in some], pa.int64()),
                      ends=pa.array([",".join(map(str, ids[x:min(x + PIECE, hi)].tolist())) for x in some], pa.string()))


def end_digests(pieces: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ids of a node's pieces, in order, read as a stream."""
    def run(batches):
        key = state = None
        for b in batches:
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends"])
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends"])

    laid = pieces.select("key", "ends", "part", "nth", "piece").repartition("key").sortWithinPartitions("key", "part", "nth", "piece")
    return arrow_map(laid, run, "key binary, ends string")


def trie(whole: DataFrame, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """Nodes of conversations (c, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    packed = blocks(whole, rows, size)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                part, nth, ids, lengths, key, chars, before, after = (b.column(j)[i].as_py() for j in range(8))
                yield from block_nodes(part, nth, np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64), key, np.frombuffer(chars, np.int64), before, after)

    given = packed.select("part", "nth", "convs", "lengths", "keys", "chars").join(edges(packed), ["part", "nth"])
    made = stage(arrow_map(given, run, _NODE))
    inner, edge, pieces = (made.where(F.col("row") == k) for k in (INNER, EDGE, ENDS))
    merged = edge.groupBy("key").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("above").alias("above"))
    merged = stage(merged.withColumn("saved", F.col("saved") - (F.col("n_convs") - 1) * F.col("above")).join(end_digests(pieces), "key", "left"))
    named = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv"))
    # a block's own nodes find parents that run over its edge by block and node: no key is hot
    local = edge.select("part", "nth", F.col("key").alias("parent")).join(named, "parent")
    below = inner.where("parent is not null").join(local, ["part", "nth", "parent"]).withColumn("parent_conv_id", F.col("parent_conv"))
    above = merged.join(named, "parent", "left").withColumn("parent_conv_id", F.col("parent_conv"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
               F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")]
    return inner.where("parent is null").select(*columns).union(below.select(*columns)).union(above.select(*columns))


def oracle() -> str:
    """DuckDB SQL for the trie of all rebuilt conversations."""
    crc = ("list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(c::VARCHAR) + 1), "
           "lambda i: list_concat([ord(substr(c::VARCHAR, i::INT, 1))::BIGINT], list_transform(range(0, 8), lambda j: -1::BIGINT))))), "
           "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)")
    return f"""WITH o AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS i FROM conversations WHERE conv_id IS NOT NULL),
      h AS (SELECT c, xor({crc}, 4294967295) % {SHARED} AS h FROM (SELECT DISTINCT conv_id AS c FROM o)),
      s AS (SELECT h.c, 0 AS own, i, r, x FROM h JOIN o ON o.conv_id = h.c - h.c % {FAMILY} AND i <= h.h
            UNION ALL SELECT h.c, 1, i, r, x FROM h JOIN o ON o.conv_id = h.c AND i > h.h),
      t AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d, r, x FROM s),
      m AS (SELECT c, d, length(x) AS tokens, to_json(list([r, x]) OVER (PARTITION BY c ORDER BY d)) AS node FROM t
            UNION ALL SELECT c, 0, 0, '[]' FROM h),
      n AS (SELECT d, node, min(c) AS c, count(*) AS n, any_value(tokens) AS tokens FROM m GROUP BY d, node),
      p AS (SELECT n.*, a.node AS up, u.c AS up_c FROM n LEFT JOIN m a ON a.c = n.c AND a.d = n.d - 1 LEFT JOIN n u ON u.node = a.node),
      k AS (SELECT up, count(*) AS children FROM p WHERE up IS NOT NULL GROUP BY up),
      b AS (SELECT a.node, sum((n.n - 1) * n.tokens) AS saved, count(*) FILTER (WHERE k.up IS NULL) AS leaves
            FROM n JOIN m a ON a.c = n.c AND a.d <= n.d LEFT JOIN k ON k.up = n.node GROUP BY a.node),
      l AS (SELECT c, max(d) AS d FROM m GROUP BY c),
      e AS (SELECT m.node, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ids FROM m JOIN l ON l.c = m.c AND l.d = m.d GROUP BY m.node)
      SELECT p.c AS conv_id, p.d::BIGINT AS depth, p.up_c AS parent_conv_id, p.n AS n_convs, coalesce(k.children, 0) AS n_children,
        b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
      FROM p JOIN b ON b.node = p.node LEFT JOIN k ON k.up = p.node LEFT JOIN e ON e.node = p.node"""
