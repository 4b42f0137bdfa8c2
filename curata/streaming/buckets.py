"""A keyed table in hash buckets whose batches write only what they change.

A row's key says its bucket; ``data/b=<bucket>/v=<batch>/full=<0|1>`` holds what a batch wrote
there.  The table has, for every key, its newest row by an order column.  A batch reads the
buckets that it touches and writes its changed rows as a version of its own; a bucket whose
later versions hold more bytes than half of its full one and than ``SMALL_BYTES``, or are more than
``MOST_VERSIONS``, is written anew as a whole.  So the bytes written, all in all, stay in
proportion to the rows changed.

A retried batch reads the versions before it again and overwrites its own, so it is
idempotent.  What a full version replaces is deleted by a later batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_VERSIONS = 16
SMALL_BYTES = 1 << 20


class Buckets:
    """The table at ``path`` as batch ``batch_id`` meets it: rows of ``schema``, one a ``key``, newest by ``order``.

    The number of buckets is given, or as many as shuffle partitions, when the table is new."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int, schema: T.StructType, key: str, order: str, buckets: int | None = None):
        self.spark, self.path, self.batch_id = spark, path.rstrip("/"), batch_id
        self.schema, self.key, self.order = schema, key, order
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        size = f"{self.path}/buckets"
        if self._fs.exists(self._hadoop(f"{size}/_SUCCESS")):
            self.buckets = spark.read.parquet(size).first()["buckets"]
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(size)

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows' keys: at most as many numbers as there are buckets."""
        return sorted(rows.agg(F.collect_set(self.bucket(F.col(self.key)))).first()[0])

    def versions(self, bucket: int) -> list[tuple[int, int, int]]:
        """(batch, full, bytes) of a bucket's versions before this batch, from the newest full one on."""
        found = []
        for f in self._fs.globStatus(self._hadoop(f"{self.path}/data/b={bucket}/v=*/full=*")) or []:
            version, full = (int(x.split("=")[1]) for x in f.getPath().toString().rsplit("/", 2)[1:])
            if version < self.batch_id:
                found.append((version, full, self._fs.getContentSummary(f.getPath()).getLength()))
        found.sort()
        last = max((i for i, v in enumerate(found) if v[1]), default=0)
        return found[last:]

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [f.name for f in self.schema.fields if f.name != self.key]
        best = F.max_by(F.struct(*rest), F.col(self.order)).alias("_best")
        return rows.groupBy(self.key).agg(best).select(*[F.col(self.key) if f.name == self.key else F.col("_best")[f.name].alias(f.name)
                                                         for f in self.schema.fields])

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The newest row of every key in these buckets (all, if none are named)."""
        paths = [f"{self.path}/data/b={b}/v={v}/full={full}" for b in (range(self.buckets) if buckets is None else buckets)
                 for v, full, _ in self.versions(b)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self._newest(self.spark.read.schema(self.schema).parquet(*paths))

    def write(self, changed: DataFrame, buckets: list[int], keep: Column | None = None) -> None:
        """Write the changed rows, whose keys lie in ``buckets``, and whole buckets where that is due;
        those leave out what isn't to ``keep``."""
        names = self.schema.fieldNames()
        have = {b: self.versions(b) for b in buckets}
        due = []
        for b, v in have.items():
            later = [size for _, _, size in v[1:]]
            if len(later) >= MOST_VERSIONS or (later and sum(later) > max(v[0][2] / 2, SMALL_BYTES)):
                due.append(b)
        rows = changed.select(*names).withColumn("b", self.bucket(F.col(self.key)))
        if due:
            whole = self._newest(self.read(due).unionByName(changed.select(*names))).withColumn("b", self.bucket(F.col(self.key))).where(F.col("b").isin(due))
            rows = rows.where(~F.col("b").isin(due)).unionByName(whole if keep is None else whole.where(keep))
        full = due + [b for b in buckets if not have[b]]
        (rows.withColumn("v", F.lit(self.batch_id)).withColumn("full", F.col("b").isin(full).cast("int") if full else F.lit(0)).repartition("b")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("b", "v", "full").parquet(f"{self.path}/data"))
        for b, v in have.items():  # what a full version of an earlier, ended batch replaces
            if v and v[0][1]:
                for f in self._fs.globStatus(self._hadoop(f"{self.path}/data/b={b}/v=*")) or []:
                    if int(f.getPath().getName().split("=")[1]) < v[0][0]:
                        self._fs.delete(f.getPath(), True)
