"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from curata.session import cut_lineage, ensure_checkpoint_dir, ship_package


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder; also readies the session (checkpoint folder, code)."""
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: short lineage, one computation."""
    return cut_lineage(df)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` after making this package importable on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


#: What a Python worker keeps from task to task, by name: how to forget it.
KEPT: dict[str, Callable[[], None]] = {}


def give_back(keeps: str | None = None) -> None:
    """Forget what other operators' tasks left in this Python worker and return freed memory to the
    system; workers outlive their stages."""
    for name, forget in KEPT.items():
        if name != keeps:
            forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another allocator: nothing to trim
        pass


def lighten(spark: SparkSession) -> None:
    """``give_back`` for the driver: its Python and its JVM return freed memory to the system.

    The JVM's threads free much outside the heap, which the C library keeps for each of them; JVMs
    that offer no trim keep it."""
    give_back()
    sc = spark.sparkContext
    java, new = sc._jvm.java.lang, sc._gateway.new_array
    name = java.Class.forName
    try:  # by the public interface: py4j looks at the class, which its module doesn't open
        kinds = new(java.Class, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = name(kind)
        values = new(java.Object, 4)
        values[0], values[1] = sc._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        name("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(java.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JError:
        pass


def trimmed(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str | None = None):
    """``fn`` for ``arrow_map``, giving back what earlier tasks and this one have freed; of what a
    worker keeps, ``keeps`` names its own."""
    def run(batches):
        give_back(keeps)
        yield from fn(batches)
        give_back(keeps)
    return run


def moderate_batches(spark: SparkSession, rows: int = 250, size: int = 2 << 20, scanned: int = 512) -> None:
    """Arrow batches of at most so many rows and bytes for the rest of the session, whose off-heap
    buffers an executor keeps between stages, and so many rows scanned at once."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size),
                      ("spark.sql.parquet.columnarReaderBatchSize", scanned)):
        now = int(spark.conf.get(key).rstrip("bB"))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256, size: int = 2 << 20):
    """Arrow batches of few rows and bytes for the jobs run inside: for wide rows."""
    keys = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else
         c if isinstance(c, pa.Array) else pa.array(c, f.type)
         for c, f in zip(columns, schema)], schema=schema)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows with equal integer keys from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        edge = np.zeros(b.num_rows, bool)
        for c in cols:
            edge[1:] |= c[1:] != c[:-1]
        at = [0, *np.flatnonzero(edge).tolist(), b.num_rows]
        same = bool(held) and all(held[-1].column(k)[held[-1].num_rows - 1].as_py() == b.column(k)[0].as_py()
                                  for k in keys)
        if held and not same:
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(at[:-1], at[1:]):
            held.append(b.slice(lo, hi - lo))
            if hi < b.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)
