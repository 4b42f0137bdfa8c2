"""T1 as a stream: anchored 24-hour repeat suppression.

``foreachBatch`` runs the batch algorithm on each micro-batch, so a hot key spreads over
many tasks, and the anchors live in hash buckets of keys, a row a key.  Rows are taken
in arrival order: within a micro-batch by ``(t, id)``, and batch after batch.  An arrival
passes if it is the first of its key or comes 24 h or more after the key's anchor; a late
one, before the anchor or within its 24 h, is a repeat.

State costs what a batch touches (``streaming.buckets``): a batch reads only the buckets that
its keys fall into and writes only the anchors that it moved.

``lateness_hours`` bounds how far behind the latest event time seen a row may come.  Rows
beyond it do not vanish: they come out with status ``late``.  A key's anchor is kept at least until
``anchor + 24 h + lateness``: after that no row that is still taken could be its repeat, and
the next time that its bucket is written anew leaves it out.  Without a bound, anchors are kept for good.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.durations import epoch_us
from curata.operators.repeats import CACHE_HOURS, MICROS_PER_HOUR, anchors
from curata.session import cut_lineage, drop_staged
from curata.streaming.buckets import Buckets

PASSED, LATE = "passed", "late"


class AnchorState(Buckets):
    """Anchors by key, and the latest event time that the batch before has seen (``meta/v=<batch>``)."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int, buckets: int | None = None):
        schema = T.StructType([T.StructField("_k", T.StringType()), T.StructField("anchor", T.LongType())])
        super().__init__(spark, path, batch_id, schema, "_k", "anchor", buckets)
        meta = f"{self.path}/meta/v={batch_id - 1}"
        row = spark.read.parquet(meta).first() if batch_id > 0 and self._fs.exists(self._hadoop(meta)) else None
        self.seen = row["seen"] if row else None

    def move(self, moved: DataFrame, buckets: list[int], horizon: int, keep_from: int | None) -> None:
        """Write the moved anchors (_k, anchor) and the latest event time seen."""
        self.write(moved, buckets, None if keep_from is None else F.col("anchor") > keep_from)
        self.spark.createDataFrame([(horizon,)], "seen long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/meta/v={self.batch_id}")
        for f in self._fs.globStatus(self._hadoop(f"{self.path}/meta/v=*")) or []:
            if int(f.getPath().getName().split("=")[1]) < self.batch_id - 1:
                self._fs.delete(f.getPath(), True)


def repeats_micro_batch(df: DataFrame, batch_id: int, keys: Sequence[str], ts: str, id_col: str,
                        out_path: str, state_path: str, hours: int = CACHE_HOURS,
                        lateness_hours: int | None = None, buckets: int | None = None) -> None:
    """T1 over one micro-batch.  Writes the rows that pass and the late ones, with ``status``,
    to the batch's partition of ``out_path``.

    State is an ``AnchorState`` under ``state_path``.  A retried batch reads the state as the
    batch before left it and rewrites its own version and output partition, so it is idempotent."""
    spark = df.sparkSession
    window = hours * MICROS_PER_HOUR
    cols = df.columns
    state = AnchorState(spark, state_path, batch_id, buckets)
    framed = df.select("*", F.to_json(F.struct(*[F.col(k) for k in keys])).alias("_k"), epoch_us(F.col(ts), df.schema[ts].dataType).alias("_t"))
    framed = cut_lineage(framed.withColumn("_b", state.bucket(F.col("_k"))))
    late = F.lit(False)
    if lateness_hours is not None and state.seen is not None:
        late = F.col("_t") < state.seen - lateness_hours * MICROS_PER_HOUR
    # what the batch touches: at most as many numbers as there are buckets
    about = framed.agg(F.max("_t").alias("t"), F.collect_set(F.when(~late, F.col("_b"))).alias("b")).first()
    touched = sorted(about["b"])
    cand = framed.where(~late)
    if batch_id > 0:  # one state row per key, so the join cannot multiply arrivals
        cand = cut_lineage(cand.join(state.read(touched), "_k", "left")
                           .where(F.col("anchor").isNull() | (F.col("_t") >= F.col("anchor") + F.lit(window))).drop("anchor"))
    passed = anchors(cand, ["_k"], "_t", id_col, hours, written=True).withColumnRenamed("id", "_pid")
    kept = cut_lineage(cand.join(passed, cand[id_col].cast("long") == passed["_pid"], "left_semi"))
    out = (kept.select(*cols, F.lit(PASSED).alias("status"))
           .unionByName(framed.where(late).select(*cols, F.lit(LATE).alias("status"))).withColumn("batch_id", F.lit(batch_id)))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path)
    horizon = max(x for x in (about["t"], state.seen, -(1 << 62)) if x is not None)
    keep_from = None if lateness_hours is None else horizon - window - lateness_hours * MICROS_PER_HOUR
    state.move(kept.groupBy("_k").agg(F.max("_t").alias("anchor")), touched, horizon, keep_from)
    drop_staged(framed, kept, *([cand] if batch_id > 0 else []))


def start_repeats_stream(stream: DataFrame, keys: Sequence[str], ts: str, id_col: str,
                         out_path: str, state_path: str, checkpoint: str, hours: int = CACHE_HOURS,
                         trigger: dict | None = None, lateness_hours: int | None = None, buckets: int | None = None):
    """Start streaming T1 (``foreachBatch``)."""
    w = (stream.writeStream
         .foreachBatch(lambda df, bid: repeats_micro_batch(df, bid, keys, ts, id_col, out_path, state_path, hours, lateness_hours, buckets))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
