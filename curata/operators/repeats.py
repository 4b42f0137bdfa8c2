"""Article cache and anchored 24-hour repeat suppression.

J5 ``cache_state`` (+ P20, F8): articles joined to the cache by ``md5(url)``:
``miss``, ``fresh`` (younger than 24 whole hours) or ``stale``.
X3/S11 ``merge_cache``: a new cache snapshot from surviving, refreshed and new rows.
T1 ``suppress_repeats``: per key, the first arrival is an *anchor* and passes;
arrivals less than 24 h after the anchor are repeats and do not move it; the
first arrival at or after anchor + 24 h passes and becomes the anchor.

Why not a fold per key.  Gathering one key's arrivals into one row (or one
``applyInPandas`` group) puts a hot key -- possibly a third of all rows -- into a
single task.  Instead (``anchors``):

1. *local walk*: arrivals are range-partitioned and sorted on ``(key, t, id)`` --
   range partitioning splits a hot key over many tasks -- and every key run in a
   partition is walked with a binary search to the next anchor.  Exact for every
   key that does not cross a partition boundary; one pass, no join.
2. *exits*: only a partition's first run can be entered from the one before.  For
   every row of it, one backward pass finds the exit: the last anchor of the walk
   that enters there (in segments of at most ``SEGMENT`` rows, so memory is bounded).
3. *carry* (keys that cross a boundary, at most one a boundary): an exit's next row,
   in a later segment, is found by sorting exits + 24 h with the entry rows.  That
   links exits to exits, one link a segment, and the exits reached from a key's
   first partition are composed by doubling: ``log2(segments)`` rounds, whatever
   the time span.  A second walk inside the entered segments lists their anchors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.durations import age_hours, epoch_us
from curata.functions.text import url_key
from curata.session import cut_lineage

# Cache life in whole hours, and what a fresh hit means.
CACHE_HOURS = 24
MICROS_PER_HOUR = 3_600_000_000
MISS, FRESH, STALE = "miss", "fresh", "stale"


# --------------------------------------------------------------------------- cache
def cache_state(articles: DataFrame, cache: DataFrame, now, on_fresh: str = "flag",
                hours: int = CACHE_HOURS, url_col: str = "url") -> DataFrame:
    """J5 + P20 + F8. Adds ``url_key``, ``fetched_at``, ``age_h``, ``cache`` (miss /
    fresh / stale) and ``action``: ``fetch`` on a miss, ``refresh`` when stale, and
    on a fresh hit ``repeated`` (``on_fresh="flag"``) or ``reuse`` (``"reuse"``,
    the cached body is used).  The cache has one row per key, so the left join
    cannot multiply articles; AQE splits a hot key on the article side."""
    if on_fresh not in ("flag", "reuse"):
        raise ValueError("on_fresh must be 'flag' or 'reuse'")
    a = articles.withColumn("url_key", url_key(url_col))
    c = cache.select("url_key", *[x for x in cache.columns if x not in ("url_key", url_col)])
    j = a.join(c, "url_key", "left")
    age = age_hours("fetched_at", now)
    state = (F.when(F.col("fetched_at").isNull(), F.lit(MISS))
             .when(F.col("age_h") < hours, F.lit(FRESH)).otherwise(F.lit(STALE)))
    action = (F.when(F.col("cache") == MISS, F.lit("fetch"))
              .when(F.col("cache") == STALE, F.lit("refresh"))
              .otherwise(F.lit("repeated" if on_fresh == "flag" else "reuse")))
    return j.withColumn("age_h", age).withColumn("cache", state).withColumn("action", action)


def merge_cache(cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """X3 + S11. New snapshot: cached rows not refetched, plus every fetched row
    (refreshed or new).  Write it to a new path; never overwrite the input."""
    keep = cache.join(fetched.select("url_key"), "url_key", "left_anti")
    return keep.unionByName(fetched.select(*cache.columns))


# --------------------------------------------------------------------------- T1 batch
def _micros(df: DataFrame, ts: str) -> Column:
    return epoch_us(F.col(ts), df.schema[ts].dataType)


_SUCC_SCHEMA = T.StructType([
    T.StructField("_row", T.IntegerType()),    # 0 resolved probe, 1 open probe, 2 partition summary
    T.StructField("_part", T.IntegerType()),
    T.StructField("_id", T.LongType()),
    T.StructField("_nid", T.LongType()),
    T.StructField("_nt", T.LongType()),
    T.StructField("_k", T.StringType()),        # summary: first key of the partition
    T.StructField("_last_k", T.StringType()),   # summary: last key of the partition
])


def _resolve_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows ``(_k, _t, _kind, _id)`` of one range partition -> probe successors."""
    part = TaskContext.get().partitionId()
    first_key = last_key = None
    first_real = None          # (t, id) of the first arrival of first_key
    first_run_open = True      # still inside the first key's run
    open_ids: list[np.ndarray] = []  # probes of last_key waiting for an arrival
    out_cols = [f.name for f in _SUCC_SCHEMA.fields]

    def frame(row, ids, nid, nt):
        n = len(ids)
        return pd.DataFrame({"_row": np.full(n, row, dtype=np.int32), "_part": np.full(n, part, dtype=np.int32),
                             "_id": ids, "_nid": nid, "_nt": nt, "_k": None, "_last_k": None})[out_cols]

    for pdf in batches:
        n = len(pdf)
        if n == 0:
            continue
        k = pdf["_k"].to_numpy(dtype=object)
        t = pdf["_t"].to_numpy(dtype=np.int64)
        kind = pdf["_kind"].to_numpy(dtype=np.int32)
        ids = pdf["_id"].to_numpy(dtype=np.int64)
        if first_key is None:
            first_key = k[0]
        real_pos = np.where(kind == 1, np.arange(n), n)
        nxt = np.minimum.accumulate(real_pos[::-1])[::-1]  # next arrival at or after each row
        nxt_c = np.minimum(nxt, n - 1)
        same = (nxt < n) & (k[nxt_c] == k)
        if first_run_open:
            in_first = k == first_key
            hit = np.flatnonzero(in_first & (kind == 1))
            if hit.size:
                first_real, first_run_open = (t[hit[0]], ids[hit[0]]), False
            elif not in_first.all():
                first_run_open = False
        # probes left open by the previous batch (all of key last_key)
        if open_ids:
            waiting = np.concatenate(open_ids)
            open_ids = []
            if k[0] == last_key and nxt[0] < n and k[nxt[0]] == last_key:
                j = nxt[0]
                yield frame(0, waiting, np.full(len(waiting), ids[j]), np.full(len(waiting), t[j]))
            elif k[0] == last_key and (k == last_key).all():
                open_ids.append(waiting)
            else:
                yield frame(0, waiting, np.full(len(waiting), None, dtype=object),
                            np.full(len(waiting), None, dtype=object))
        probe = kind == 0
        found = probe & same
        if found.any():
            j = nxt[found]
            yield frame(0, ids[found], ids[j], t[j])
        missing = probe & ~same
        tail = missing & (k == k[n - 1]) & (nxt >= n)   # key runs on past this batch
        done = missing & ~tail
        if done.any():
            m = int(done.sum())
            yield frame(0, ids[done], np.full(m, None, dtype=object), np.full(m, None, dtype=object))
        if tail.any():
            open_ids.append(ids[tail])
        last_key = k[n - 1]
    if first_key is None:
        return
    if open_ids:
        waiting = np.concatenate(open_ids)
        yield frame(1, waiting, np.full(len(waiting), None, dtype=object), np.full(len(waiting), None, dtype=object))
    summary = pd.DataFrame({"_row": [2], "_part": [part], "_id": [None],
                            "_nid": [None if first_real is None else int(first_real[1])],
                            "_nt": [None if first_real is None else int(first_real[0])],
                            "_k": [first_key], "_last_k": [last_key]})[out_cols]
    yield summary


def _base(df: DataFrame, keys: Sequence[str], ts: str, id_col: str) -> DataFrame:
    """``(_k, _t, _id)``: the key as one comparable string, time in micros, unique id."""
    key = F.to_json(F.struct(*[F.col(k) for k in keys]))
    return df.select(key.alias("_k"), _micros(df, ts).alias("_t"), F.col(id_col).cast("long").alias("_id"))


def _n_parts(df: DataFrame, partitions: int | None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _resolved(rows: DataFrame, n: int) -> DataFrame:
    """``(id, nxt_id, nxt_t)`` for the probes (``_kind`` 0) of ``(_k, _t, _kind, _id)``: the
    first arrival (``_kind`` 1) of the key at or after the probe's time."""
    order = ["_k", "_t", "_kind", "_id"]
    laid = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # One evaluation feeds both uses below; also a recovery point.
    m = cut_lineage(laid.mapInPandas(_resolve_partition, _SUCC_SCHEMA))

    summ = m.where(F.col("_row") == 2).select(
        "_part", F.col("_k").alias("first_key"), "_last_k",
        F.when(F.col("_nid").isNotNull(), F.struct(F.col("_nt").alias("t"), F.col("_nid").alias("id"))).alias("fr"))
    # First known arrival of a key at or after each partition, among partitions led by that key.
    ahead = Window.partitionBy("first_key").orderBy("_part").rowsBetween(0, Window.unboundedFollowing)
    summ = summ.withColumn("fr_from", F.first("fr", ignorenulls=True).over(ahead))
    by_part = Window.orderBy("_part")  # one row per partition: bounded
    carry = summ.select(
        "_part",
        F.when(F.lead("first_key").over(by_part) == F.col("_last_k"), F.lead("fr_from").over(by_part)).alias("c"))
    resolved = m.where(F.col("_row") == 0).select("_id", "_nid", "_nt")
    opened = (m.where(F.col("_row") == 1).select("_part", "_id")
              .join(F.broadcast(carry), "_part", "left")
              .select("_id", F.col("c.id").alias("_nid"), F.col("c.t").alias("_nt")))
    return resolved.unionByName(opened).select(
        F.col("_id").alias("id"), F.col("_nid").alias("nxt_id"), F.col("_nt").alias("nxt_t"))


def _probes(rows: DataFrame, delta_us: int) -> DataFrame:
    return rows.select("_k", (F.col("_t") + F.lit(delta_us)).alias("_t"), F.lit(0).alias("_kind"), "_id")


def _arrivals(rows: DataFrame) -> DataFrame:
    return rows.select("_k", "_t", F.lit(1).alias("_kind"), "_id")


def successor(df: DataFrame, keys: Sequence[str], ts: str, id_col: str, delta_us: int,
              partitions: int | None = None) -> DataFrame:
    """For every row: ``(id, nxt_id, nxt_t)``, the first row of the same key with
    ``t >= t_row + delta_us`` in ``(t, id)`` order (null when there is none).
    ``id_col`` must be unique.  Skew-safe: see the module docstring."""
    base = _base(df, keys, ts, id_col)
    return _resolved(_arrivals(base).unionByName(_probes(base, delta_us)), _n_parts(df, partitions))


#: Rows of a partition's first run that one backward pass takes at once.
SEGMENT = 1 << 20

_LOCAL_SCHEMA = T.StructType([
    T.StructField("_row", T.IntegerType()),    # 1 row of the first run, 2 partition summary, 3 local anchor
    T.StructField("_part", T.IntegerType()),
    T.StructField("_seg", T.IntegerType()),    # first run: its segment; summary: how many it has
    T.StructField("_id", T.LongType()),
    T.StructField("_t", T.LongType()),
    T.StructField("_k", T.StringType()),       # key; summary: first key
    T.StructField("_last_k", T.StringType()),  # summary: last key
    T.StructField("_exit_id", T.LongType()),   # where the walk from this row ends; summary: the last key's last anchor
    T.StructField("_exit_t", T.LongType()),
])


def exits(t: np.ndarray, window_us: int) -> np.ndarray:
    """For every row of sorted times: the row of the last anchor if the walk enters at it."""
    nxt = np.searchsorted(t, t + window_us, side="left")
    out = np.where(nxt < len(t), nxt, np.arange(len(t)))
    while True:
        further = out[out]
        if (further == out).all():
            return out
        out = further


def _local_pass(window_us: int, segment: int):
    columns = [f.name for f in _LOCAL_SCHEMA.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Walk the sorted rows batch by batch; carried are the open key's anchor and an open segment."""
        part, seg = TaskContext.get().partitionId(), 0
        first = last = anchor = anchor_id = None
        run_t: list[np.ndarray] = []
        run_id: list[np.ndarray] = []

        def frame(row, n, **given):
            return pd.DataFrame({c: given.get(c) for c in columns} | {"_row": np.full(n, row, np.int32), "_part": np.full(n, part, np.int32)},
                                index=range(n))

        def flush():
            t, ids = np.concatenate(run_t), np.concatenate(run_id)
            to = exits(t, window_us)
            return frame(1, len(t), _seg=np.full(len(t), seg, np.int32), _id=ids, _t=t, _k=first, _exit_id=ids[to], _exit_t=t[to])

        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf["_k"].to_numpy(dtype=object)
            t = pdf["_t"].to_numpy(dtype=np.int64)
            ids = pdf["_id"].to_numpy(dtype=np.int64)
            if first is None:
                first = k[0]
            cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
            own = len(k) if k[-1] == first else int(cuts[0]) if k[0] == first else 0  # rows of the first run
            for lo in range(0, own, segment):
                hi = min(own, lo + segment)
                if run_t and sum(map(len, run_t)) + hi - lo > segment:
                    yield flush()
                    seg, run_t, run_id = seg + 1, [], []
                run_t.append(t[lo:hi])
                run_id.append(ids[lo:hi])
            pos: list[int] = []
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(k)]):
                if k[s] != last:
                    last, anchor = k[s], None
                i = s if anchor is None else s + int(np.searchsorted(t[s:e], anchor + window_us, side="left"))
                while i < e:
                    pos.append(i)
                    anchor, anchor_id = int(t[i]), int(ids[i])
                    i = s + int(np.searchsorted(t[s:e], anchor + window_us, side="left"))
            at = np.asarray(pos, dtype=np.int64)
            yield frame(3, len(at), _id=ids[at], _k=k[at])
        if first is not None:
            yield flush()
            yield frame(2, 1, _seg=np.int32(seg + 1), _k=first, _last_k=last, _exit_id=anchor_id, _exit_t=anchor)
    return run


def _walk_entered(window_us: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Anchors of sorted segments from their entered row on."""
        seg = anchor = None
        for pdf in batches:
            if not len(pdf):
                continue
            t, ids = pdf["_t"].to_numpy(np.int64), pdf["_id"].to_numpy(np.int64)
            entered = pdf["_entered"].to_numpy(bool)
            own = pdf["_part"].to_numpy(np.int64) << 32 | pdf["_seg"].to_numpy(np.int64)
            cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
            pos: list[int] = []
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)]):
                if own[s] != seg:
                    seg, anchor = own[s], None
                if anchor is None:
                    here = np.flatnonzero(entered[s:e])
                    i = s + int(here[0]) if len(here) else e
                else:
                    i = s + int(np.searchsorted(t[s:e], anchor + window_us, side="left"))
                while i < e:
                    pos.append(i)
                    anchor = int(t[i])
                    i = s + int(np.searchsorted(t[s:e], anchor + window_us, side="left"))
            yield pd.DataFrame({"id": ids[np.asarray(pos, dtype=np.int64)]})
    return run


def _carried(table: DataFrame, starts: DataFrame, window: int, n: int, hops: int) -> DataFrame:
    """Anchor ids in the segments of ``table`` that the walks from ``starts`` (_k, _exit_id, _exit_t)
    enter; a key has ``hops`` segments at most."""
    left = table.select("_k", "_exit_id", "_exit_t").unionByName(starts).distinct()
    probes = _probes(left.select("_k", F.col("_exit_t").alias("_t"), F.col("_exit_id").alias("_id")), window)
    nxt = _resolved(_arrivals(table).unionByName(probes), n)
    links = cut_lineage(nxt.where(F.col("nxt_id").isNotNull()).join(table.select("_id", F.col("_exit_id").alias("b")), F.col("nxt_id") == F.col("_id"))
                        .select(F.col("id").alias("a"), F.col("nxt_id").alias("entry"), "b"))
    levels = [links.select("a", "b")]
    for _ in range((hops - 1).bit_length()):  # a walk enters every segment once at most
        x, y = levels[-1].alias("x"), levels[-1].alias("y")
        levels.append(cut_lineage(x.join(y, F.col("x.b") == F.col("y.a")).select("x.a", "y.b")))
    reached = starts.select(F.col("_exit_id").alias("a"))
    for level in reversed(levels):
        step = reached.unionByName(reached.join(level, "a").select(F.col("b").alias("a")))
        reached = step if level is levels[0] else cut_lineage(step)
    entered = links.join(reached, "a", "left_semi").select(F.col("entry").alias("_id"), F.lit(True).alias("_entered"))
    rows = (table.select("_part", "_seg", "_t", "_id").join(entered, "_id", "left")
            .withColumn("_entered", F.coalesce("_entered", F.lit(False))))
    laid = rows.repartition(n, "_part", "_seg").sortWithinPartitions("_part", "_seg", "_t", "_id")
    return laid.mapInPandas(_walk_entered(window), "id long")


def anchors(df: DataFrame, keys: Sequence[str], ts: str, id_col: str,
            hours: int = CACHE_HOURS, partitions: int | None = None, written: bool = False,
            segment: int = SEGMENT) -> DataFrame:
    """Ids of the anchors (the arrivals that pass), one column ``id``; the steps are those of the
    module docstring.  ``written``: the input is a table already, so it isn't written again
    before it is read twice (range partitioning samples it first)."""
    window = hours * MICROS_PER_HOUR
    n = _n_parts(df, partitions)
    base = _base(df, keys, ts, id_col)
    base = base if written else cut_lineage(base)
    order = ["_k", "_t", "_id"]
    laid = base.repartitionByRange(n, *order).sortWithinPartitions(*order)
    m = cut_lineage(laid.mapInPandas(_local_pass(window, segment), _LOCAL_SCHEMA))
    summ = m.where(F.col("_row") == 2)
    by_part = Window.orderBy("_part")  # one row per partition: bounded
    on = F.lead("_k").over(by_part) == F.col("_last_k")
    found = (summ.select("_part", F.when(on, F.col("_last_k")).alias("_k"), F.lead("_seg").over(by_part).alias("_n")).where(F.col("_k").isNotNull())
             .groupBy("_k").agg(F.min("_part").alias("_start"), F.sum("_n").alias("_hops")).collect())  # at most one key per partition boundary
    if not found:
        return m.where(F.col("_row") == 3).select(F.col("_id").alias("id"))
    crossing = df.sparkSession.createDataFrame([(r["_k"], r["_start"]) for r in found], "_k string, _start int")
    local = (m.where(F.col("_row") == 3).join(F.broadcast(crossing), "_k", "left")
             .where(F.col("_start").isNull() | (F.col("_part") == F.col("_start"))).select(F.col("_id").alias("id")))
    table = (m.where(F.col("_row") == 1).join(F.broadcast(crossing), "_k").where(F.col("_part") > F.col("_start"))
             .select("_part", "_seg", "_k", "_t", "_id", "_exit_id", "_exit_t"))
    starts = (summ.join(F.broadcast(crossing.withColumnRenamed("_k", "_key")), (F.col("_last_k") == F.col("_key")) & (F.col("_part") == F.col("_start")))
              .select(F.col("_key").alias("_k"), "_exit_id", "_exit_t"))
    return local.unionByName(_carried(table, starts, window, n, max(r["_hops"] for r in found)))


def mark_repeats(df: DataFrame, keys: Sequence[str], ts: str, id_col: str,
                 hours: int = CACHE_HOURS, partitions: int | None = None) -> DataFrame:
    """T1. Every row with ``repeat`` = not an anchor."""
    a = anchors(df, keys, ts, id_col, hours, partitions).select(
        F.col("id").alias("_aid"), F.lit(True).alias("_anchor"))
    return (df.join(a, df[id_col].cast("long") == a["_aid"], "left")
            .withColumn("repeat", F.col("_anchor").isNull()).drop("_aid", "_anchor"))


def suppress_repeats(df: DataFrame, keys: Sequence[str], ts: str, id_col: str,
                     hours: int = CACHE_HOURS, partitions: int | None = None) -> DataFrame:
    """T1 batch. The rows that pass (anchors); repeats are left out."""
    a = anchors(df, keys, ts, id_col, hours, partitions)
    return df.join(a.withColumnRenamed("id", id_col), id_col, "left_semi")
