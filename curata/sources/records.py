"""CSV files with quoted line ends, read by many tasks.

Spark reads a CSV file with quoted line ends (``multiLine``) in one task.  Here files are
read as lines, which split anywhere, and the lines are put together:

1. a map counts each line's quotes and keeps, from the start of its split, whether an odd
   number stood before it, and how many records began so far if the split itself starts outside
   or inside quotes;
2. prefix sums over the splits of a file (a row a split) tell which of the two is true, and
   how many records began before the split;
3. a line that starts and ends outside quotes is a record, and lines of a longer one that lie
   together are joined where they lie; only parts of records cut by a split or a batch are
   shuffled, by file and record.

A task reads as many splits as make up ``TASK_BYTES``, so small splits don't make many tasks.

The number of a record in its file comes out of the same sums.  Fields are parsed by Spark's
own ``from_csv``.  A quote inside an unquoted field counts like any other; one that is never
closed runs to the file's end, without its last line end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.session import cut_lineage, ship_package

#: Splits up to which their sums go to all executors; beyond, Spark joins by shuffle.
MOST_SENT = 1_000_000
#: Bytes of files that a task reads, about, if its splits are smaller.
TASK_BYTES = 32 << 20
_LINES = ("file string, split bigint, nth bigint, value string, inside boolean, odd boolean, "
          "starts_outside bigint, starts_inside bigint")


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, split, value, quotes) of a partition -> their place and parity from their split's start on."""
    at = None
    nth = quotes = outside = inside = 0
    for b in batches:
        if not b.num_rows:
            continue
        files, splits = b.column(0).to_pylist(), b.column(1).to_numpy()
        q = b.column(3).to_numpy().astype(np.int64)
        new = [0, *(i for i in range(1, len(files)) if splits[i] != splits[i - 1] or files[i] != files[i - 1]), len(files)]
        for lo, hi in zip(new[:-1], new[1:]):
            if (files[lo], splits[lo]) != at:
                at, nth, quotes, outside, inside = (files[lo], splits[lo]), 0, 0, 0, 0
            n = hi - lo
            before = (quotes + np.cumsum(q[lo:hi]) - q[lo:hi]) % 2 == 1
            from_outside, from_inside = outside + np.cumsum(~before), inside + np.cumsum(before)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, n), b.column(1).slice(lo, n), pa.array(np.arange(nth, nth + n)), b.column(2).slice(lo, n),
                 pa.array(before), pa.array(q[lo:hi] % 2 == 1), pa.array(from_outside), pa.array(from_inside)],
                ["file", "split", "nth", "value", "inside", "odd", "starts_outside", "starts_inside"])
            nth, quotes = nth + n, int(quotes + q[lo:hi].sum()) % 2
            outside, inside = int(from_outside[-1]), int(from_inside[-1])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Placed lines -> records, and parts of such as end with a batch or a split (``whole`` false)."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        file = b.column(0).dictionary_encode().indices.to_numpy()
        split, nth, position = (b.column(i).to_numpy() for i in (1, 2, 6))
        inside, odd = (b.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
        new = np.ones(n, bool)
        new[1:] = (file[1:] != file[:-1]) | (split[1:] != split[:-1]) | (nth[1:] != nth[:-1] + 1) | (position[1:] != position[:-1])
        first = np.flatnonzero(new)
        edge = np.append(first, n)
        last = edge[1:] - 1
        at = pa.array(first)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(at), b.column(1).take(at), b.column(2).take(at),
             pc.binary_join(pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), b.column(3)), "\n"),
             pa.array(position[first]), pa.array(~inside[first] & (inside[last] == odd[last]))],
            ["file", "split", "nth", "value", "position", "whole"])


def _tasks(spark: SparkSession, path: str) -> int:
    """Tasks of about ``TASK_BYTES`` of the files, but one a core at least."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = sum(fs.getContentSummary(f.getPath()).getLength() for f in fs.globStatus(hpath) or [])
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def read_lines(spark: SparkSession, path: str, escape: str, split_bytes: int | None = None) -> DataFrame:
    """Written: the lines of all files with their place in their split and their parity there.

    ``split_bytes`` is the size of a split, if not the session's."""
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_name").alias("file"),
                                                                 F.col("_metadata.file_block_start").alias("split"))
    marks = "value" if escape == '"' else F.regexp_replace("value", r"\\.", "")  # a doubled quote counts twice, an escaped one not
    quotes = F.length(marks) - F.length(F.replace(marks, F.lit('"'), F.lit("")))
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    if split_bytes:
        spark.conf.set(conf, str(split_bytes))
    try:
        return cut_lineage(lines.select("file", "split", "value", quotes.cast("long").alias("q")).coalesce(_tasks(spark, path)).mapInArrow(_number, _LINES))
    finally:
        spark.conf.set(conf, before)


def read_records(spark: SparkSession, path: str, escape: str = '"', split_bytes: int | None = None) -> DataFrame:
    """``(file_name, position, record)``: the records of all files; ``position`` counts them from 0 in
    their file (the header, too).  A ``\\r`` before a record's end belongs to the line end."""
    lines = read_lines(spark, path, escape, split_bytes)
    sums = lines.groupBy("file", "split").agg(F.sum(F.col("odd").cast("int")).alias("odd"), F.max("starts_outside").alias("outside"),
                                              F.max("starts_inside").alias("inside"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("enters", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    sums = sums.withColumn("own", F.when(F.col("enters"), F.col("inside")).otherwise(F.col("outside")))
    sums = cut_lineage(sums.select("file", "split", "enters", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("records")))
    sums = F.broadcast(sums) if sums.count() <= MOST_SENT else sums
    # outside quotes before the line: a record starts here; outside after it: a record ends here
    placed = lines.join(sums, ["file", "split"]).select(
        "file", "split", "nth", "value", (F.col("inside") != F.col("enters")).alias("inside"), "odd",
        (F.col("records") + F.when(F.col("enters"), F.col("starts_inside")).otherwise(F.col("starts_outside")) - 1).alias("position"))
    joined = placed.mapInArrow(_records, "file string, split bigint, nth bigint, value string, position bigint, whole boolean")
    cut = joined.where("not whole").groupBy("file", "position").agg(F.array_sort(F.collect_list(F.struct("split", "nth", "value"))).alias("p"))
    both = joined.where("whole").select("file", "position", "value").unionByName(
        cut.select("file", "position", F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value")))
    return both.select(F.col("file").alias("file_name"), "position", F.regexp_replace("value", "\r$", "").alias("record"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, escape: str, null: str, split_bytes: int | None = None) -> DataFrame:
    """``(file_name, position, *schema)`` of every record but the header and blank lines.

    A missing field is null, an empty one empty; fields beyond the schema are left out."""
    options = {"escape": escape, "nullValue": null, "emptyValue": "", "mode": "PERMISSIVE", "multiLine": "true", "lineSep": "\n"}
    rows = read_records(spark, path, escape, split_bytes).where((F.col("position") > 0) & (F.col("record") != ""))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select("file_name", "position", F.from_csv("record", ddl, options).alias("r")).select("file_name", "position", "r.*")
