"""Shards by extendible hashing (operator 2).

Every row hashes to 128 bits (MD5 of its key as text).  The directory is indexed by a
prefix of these bits: a bucket that holds more than ``limit`` bytes splits on one bit
more, and only such a bucket does, until every shard fits.  A shard is named by its prefix.

Sizes come from one aggregate over prefixes of the depth that bytes / limit suggests and a few
bits more (``STEP`` at least), summed up over shorter prefixes: the last ``NEAR`` bits bit by
bit, what is above from sums that are that much fewer.  A bucket that is too large even at that
depth is resolved by its next ``STEP`` bits, so
a table needs as many passes over small (hash, bytes) rows as its depth holds steps.  The
texts are read once for their lengths and never shuffled by the assignment.

Rows of one key share all bits.  When their bucket at full depth is too large they get
overflow shards, numbered inside each input partition: rows of over half the limit stand
alone, the others fill shards by half the limit and one row more, so none passes it.  A single row
beyond the limit is a shard of its own (``oversized``).

Defined results: a null text has no bytes; a null key hashes as the empty text; repeated
rows are placed together as far as the limit allows; an empty table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from curata.llm.common import stage

SHARD_BYTES = 1 << 20
STEP = 16
NEAR = 8
DEPTH = 128
#: Directory rows up to which the directory goes to all executors; beyond, Spark joins by shuffle.
MOST_SENT = 2_000_000


def hash_bits(key: Column) -> Column:
    """The 128 bits as text of 0 and 1."""
    digits = F.split(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), "")
    return F.array_join(F.transform(digits, lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")


def _fitting(rows: DataFrame, name: str, first: int, last: int, limit: int, at_end: bool) -> DataFrame:
    """(name, e): of each prefix ``name`` of ``last`` bits the shortest prefix, of ``first`` bits at
    least, that fits; with ``at_end`` the whole one if none does.  Rows are (name, bytes, docs)."""
    levels = rows.select(name, "bytes", "docs", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"substring({name}, 1, depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.lit(at_end) & (F.col("depth") == last))
    return (levels.select(name, "depth", "prefix").join(sums.where(fits), ["depth", "prefix"])
            .groupBy(name).agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("e")))


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """(width, leaf, prefix, shard_bytes, shard_docs) from rows (bits, bytes).

    ``leaf`` is the prefix of ``width`` bits that finds the entry; entries of a greater width
    belong to buckets that the one before could not resolve."""
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    width = min(DEPTH, max(STEP, math.ceil(math.log2(max(total / limit, 1))) + 4))
    found, rows, before = None, sizes, -1
    while True:
        leaves = stage(rows.groupBy(F.substring("bits", 1, width).alias("leaf"))
                       .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs")))
        middle = max(before + 1, width - NEAR)
        cut = F.substring("leaf", 1, middle).alias("middle")
        above = _fitting(leaves.groupBy(cut).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")), "middle", before + 1, middle, limit, middle == DEPTH)
        both = stage(leaves.select("*", cut).join(above, "middle", "left").select("leaf", "bytes", "docs", "e"))
        below = both.where("e is null")
        near = _fitting(below, "leaf", middle + 1, width, limit, width == DEPTH) if middle < width else below.select("leaf", "e").limit(0)
        entry = both.where("e is not null").select("leaf", "e").union(near)
        entry = stage(entry.select(F.lit(width).alias("width"), "leaf", "e.prefix", "e.shard_bytes", "e.shard_docs"))
        found = entry if found is None else found.union(entry)
        if width == DEPTH:
            return found
        open_leaves = stage(below.select("leaf").join(entry.select("leaf"), "leaf", "left_anti"))
        if open_leaves.isEmpty():
            return found
        rows = stage(rows.withColumn("leaf", F.substring("bits", 1, width)).join(open_leaves, "leaf", "left_semi").select("bits", "bytes"))
        before, width = width, min(DEPTH, width + STEP)


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (row, k, bytes, bits), with the shard of each: (row, k, bytes, shard, prefix, shard_bytes, shard_docs)."""
    entries = directory(rows, limit)
    count = entries.count()
    widths = sorted(r[0] for r in entries.select("width").distinct().collect())  # at most DEPTH / STEP
    out = rows
    for w in widths:
        e = entries.where(F.col("width") == w).select(F.col("leaf").alias(f"l{w}"), F.struct("prefix", "shard_bytes", "shard_docs").alias(f"e{w}"))
        out = out.join(F.broadcast(e) if count <= MOST_SENT else e, F.substring("bits", 1, w) == F.col(f"l{w}"), "left")
    e = F.coalesce(*[F.col(f"e{w}") for w in widths]) if widths else F.lit(None).cast("struct<prefix:string,shard_bytes:bigint,shard_docs:bigint>")
    out = out.select("row", "k", "bytes", e["prefix"].alias("prefix"), e["shard_bytes"].alias("shard_bytes"), e["shard_docs"].alias("shard_docs"))
    full = (F.length("prefix") == DEPTH) & (F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1)
    chained, plain = out.where(full), out.where(~full)
    # rows of one key: numbered inside each partition, so that no task gathers them
    near = Window.partitionBy("prefix", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    small = 2 * F.col("bytes") <= limit
    filled = F.coalesce(F.sum(F.when(small, F.col("bytes")).otherwise(0)).over(near), F.lit(0))
    number = F.when(small, F.floor(2 * filled / F.lit(limit)).cast("string")).otherwise(F.concat(F.lit("r"), F.col("row").cast("string")))
    chained = chained.withColumn("part", F.spark_partition_id()).withColumn("n", number)
    chained = chained.withColumn("shard", F.concat_ws("+", "prefix", F.concat_ws(".", F.col("part").cast("string"), "n")))
    sums = chained.groupBy("shard").agg(F.sum("bytes").alias("b"), F.count("*").alias("d"))
    chained = chained.join(sums, "shard").select("row", "k", "bytes", "shard", "prefix", F.col("b").alias("shard_bytes"), F.col("d").alias("shard_docs"))
    return plain.select("row", "k", "bytes", F.col("prefix").alias("shard"), "prefix", "shard_bytes", "shard_docs").union(chained)


def _rows(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """Staged rows (row, k, bytes, bits, *more), each with a number of its own."""
    size = F.coalesce(F.octet_length(docs[text].cast("string")), F.lit(0)).cast("long")
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("k"), size.alias("bytes"), *more)
                 .withColumn("bits", hash_bits(F.col("k"))))


def assign(docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, bytes, shard, depth, shard_bytes, shard_docs, oversized) of every row.

    ``shard`` is the prefix (empty: one shard for all), with ``+n`` for an overflow shard."""
    return _placed(_rows(docs, key, text), limit).select(
        F.col("k").alias(key), "bytes", "shard", F.length("prefix").cast("int").alias("depth"),
        "shard_bytes", "shard_docs", (F.col("shard_bytes") > limit).alias("oversized"))


def write(docs: DataFrame, path: str, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> None:
    """Write every row once, one folder a shard (``shard=prefix``), each by one task.

    The rows are written aside with the numbers by which they find their shards, so repeated
    keys and rows stay apart.  A column named ``shard`` (in any case) would clash with the folders:
    it is kept as ``shard_`` with as many underscores as it takes."""
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("whole")
    rows = _rows(docs, key, text, whole)
    placed = _placed(rows.select("row", "k", "bytes", "bits"), limit).select("row", "shard")
    names, taken = [], {c.lower() for c in docs.columns}
    for c in docs.columns:
        new = c
        while new.lower() == "shard" or (new != c and new.lower() in taken):
            new += "_"
        names.append(new)
    out = rows.select("row", "whole").join(placed, "row").select(*[F.col("whole")[c].alias(n) for c, n in zip(docs.columns, names)], "shard")
    out.repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int = SHARD_BYTES, depth: int = 24) -> str:
    """DuckDB SQL for ``assign`` over documents whose shards are at most ``depth`` bits deep."""
    nibble = " ".join(f"WHEN '{d:x}' THEN '{d:04b}'" for d in range(16))
    return f"""WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes,
        array_to_string(list_transform(range(1, 9), lambda i: CASE substr(md5(coalesce(doc_id::VARCHAR, '')), i::INT, 1) {nibble} END), '') AS bits FROM documents),
      l AS (SELECT depth, substr(bits, 1, depth::INT) AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
        FROM d, range(0, {depth + 1}) r(depth) GROUP BY ALL),
      f AS (SELECT doc_id, bytes, bits, min(depth) AS depth FROM d JOIN l ON l.prefix = substr(bits, 1, depth::INT)
        WHERE shard_bytes <= {limit} OR shard_docs = 1 GROUP BY ALL)
      SELECT doc_id, bytes, prefix AS shard, f.depth::INT AS depth, shard_bytes, shard_docs, shard_bytes > {limit} AS oversized
      FROM f JOIN l ON l.depth = f.depth AND l.prefix = substr(bits, 1, f.depth::INT)"""
