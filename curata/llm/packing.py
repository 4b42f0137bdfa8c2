"""Concatenate and cut (operator 1).

All documents stand one after another in one stream of ids, each followed by an end id;
the stream is cut into windows of ``length`` ids.  Two passes:

1. every partition encodes its documents, writes them with their offset inside the
   partition, and its total is known; prefix sums over the totals give every partition
   its offset in the stream (one number a partition);
2. every partition cuts its documents at the multiples of ``length`` by itself.  A
   document that crosses such a boundary, or the window that crosses a partition's edge,
   leaves boundary records: pieces with the sequence and the offset they belong to.

Nothing is shuffled; only the last window is padded.  ``sequences`` puts the pieces of
each window together: windows inside one partition would be local, and the shuffle that
it needs is by sequence id, even by construction.

Defined results: a null or empty text is the end id alone; repeated rows and repeated ids
are packed once a row; an empty table gives no pieces; a text of any length is cut over
as many windows as it fills.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from curata.llm import bpe
from curata.llm.common import arrow_map, stage, trimmed

SEQUENCE_LENGTH = 1024
END_ID = 0
#: Code points of text encoded at once: the splitter takes about 40 bytes for each.
SLICE = 1_000_000
#: Words whose ids an encoder keeps: 44 bytes each, and three times that while it learns.
KNOWN_WORDS = 600_000
#: Above this many partitions the offsets are joined by a shuffle, not sent to all.
MOST_SENT = 1_000_000


def encode_stream(docs: DataFrame, vocabulary: str, key: str, text: str, end_id: int) -> DataFrame:
    """Pass 1, staged: (part, start in the partition, n, key, ids as little-endian uint32)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        encoder, part, start = bpe.encoder(vocabulary, KNOWN_WORDS), TaskContext.get().partitionId(), 0
        for b in batches:
            for first, texts in bpe.text_slices(b.column(1), SLICE):
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                n = counts + 1
                edge = np.concatenate([[0], np.cumsum(n)])
                starts = start + edge[:-1]
                start += int(edge[-1])
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(texts), [None, pa.py_buffer((edge * 4).astype(np.int64)), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(texts), part, np.int64)), pa.array(starts.astype(np.int64)), pa.array(n.astype(np.int64)),
                     b.column(0).slice(first, len(texts)), data.cast(pa.binary())], ["part", "start", "n", "k", "ids"])

    return stage(arrow_map(docs.select(docs[key], docs[text]), trimmed(run, keeps="bpe"),
                           f"part bigint, start bigint, n bigint, k {kind}, ids binary"))


def pack(docs: DataFrame, vocabulary: str, length: int = SEQUENCE_LENGTH, end_id: int = END_ID,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: (key, start, length, doc_tokens, sequence_id, offset, ids).

    ``start`` counts the document's ids before the piece, ``offset`` those of the
    sequence; ``ids`` are little-endian unsigned 32-bit."""
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    stream = encode_stream(docs, vocabulary, key, text, end_id)
    totals = stream.groupBy("part").agg(F.sum("n").alias("total"))
    parts = totals.count()
    if parts <= MOST_SENT:  # one row a partition: its size is known here
        rows = sorted((r.part, r.total) for r in totals.collect())
        base = np.cumsum([0] + [t for _, t in rows])[:-1]
        # from Arrow: rows of Python objects would pass Python workers of another kind, which stay
        known = pa.table({"part": pa.array([p for p, _ in rows], pa.int64()), "base": pa.array(base, pa.int64())})
        offsets = F.broadcast(spark.createDataFrame(known))
    else:
        before = totals.alias("a").groupBy(F.floor(F.col("part") / 1000).alias("block")).agg(F.sum("total").alias("t"))
        from pyspark.sql import Window
        before = before.withColumn("b", F.sum("t").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
        inner = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (totals.withColumn("block", F.floor(F.col("part") / 1000)).join(before.select("block", "b"), "block")
                   .select("part", (F.coalesce("b", F.lit(0)) + F.coalesce(F.sum("total").over(inner), F.lit(0))).alias("base")))

    def cut(batches):
        for b in batches:
            if not b.num_rows:
                continue
            at = b.column(0).to_numpy()
            n = b.column(1).to_numpy()
            first, last = at // length, (at + n - 1) // length
            count = last - first + 1
            doc = np.repeat(np.arange(len(n)), count)
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            window = first[doc] + nth
            lo = np.maximum(window * length, at[doc])
            hi = np.minimum((window + 1) * length, (at + n)[doc])
            ids = b.column(3)
            bounds = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64)
            # the pieces of a batch lie in its ids one after another
            edge = np.concatenate([[0], np.cumsum((hi - lo) * 4)])
            data = memoryview(ids.buffers()[2])[int(bounds[0]):int(bounds[-1])] if len(bounds) else b""
            # pieces of under 2**31 bytes a batch: Arrow batches of binary columns hold no more
            out = pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(bytes(data))])
            yield pa.RecordBatch.from_arrays(
                [b.column(2).take(pa.array(doc)), pa.array(lo - at[doc]), pa.array(hi - lo), pa.array(n[doc]),
                 pa.array(window), pa.array(lo - window * length), out],
                ["k", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    placed = (stream.join(offsets, "part")
              .select((F.col("base") + F.col("start")).alias("at"), "n", "k", "ids"))
    out = arrow_map(placed, trimmed(cut), f"k {kind}, start bigint, length bigint, doc_tokens bigint, "
                                 "sequence_id bigint, offset bigint, ids binary")
    return out.withColumnRenamed("k", key)


def sequences(pieces: DataFrame, length: int = SEQUENCE_LENGTH, pad_id: int = END_ID) -> DataFrame:
    """(sequence_id, ids array<int>) of ``length`` ids each: the pieces by offset, the last padded.

    A sequence has at most ``length`` pieces, so a group is bounded."""
    ints = F.expr("transform(sequence(1, length(ids), 4), i -> cast(conv(concat(hex(substring(ids, i + 3, 1)), "
                  "hex(substring(ids, i + 2, 1)), hex(substring(ids, i + 1, 1)), hex(substring(ids, i, 1))), 16, 10) as int))")
    whole = (pieces.groupBy("sequence_id")
             .agg(F.array_sort(F.collect_list(F.struct("offset", ints.alias("ids")))).alias("p"))
             .select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids")))
    pad = F.array_repeat(F.lit(pad_id), (F.lit(length) - F.size("ids")).cast("int"))
    return whole.select("sequence_id", F.concat("ids", pad).alias("ids"))
