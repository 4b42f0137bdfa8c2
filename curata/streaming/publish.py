"""Incremental publishing as a stream.

Each micro-batch of articles goes through keep-first, the ledger anti join, the choice of
one folder a URL, generation, clean-up and the gate, and its published rows are appended
to the ledger with the normal form of their URL as it came.  Safe to repeat: the anti
join runs against the keys stored in the ledger as committed, so a URL published by an
earlier batch (or run, or for another folder) is never generated again, and a retried
batch rewrites only its own ``batch_id`` partition of the results table.

What a batch doesn't publish (errors, rejects, articles without a page) isn't in the ledger, so
it has to come up again.  With ``retry_path`` such rows are kept, for all their folders, as
version ``v=<batch_id>`` of a table there, and the next batch takes them in with its own
rows.  A retried batch reads the same version again and rewrites its own.

With ``cache_path`` the article cache stands in front of generation (J5, F8): each batch reads
the cache buckets that its URLs fall into, as the batch before left them, and a fresh hit is
``repeated`` and neither fetched nor generated.  What the batch fetched is written to the cache as its
own version.

The generator is called once per URL and batch: the full result is written to the
results table first, and the ledger rows are read back from it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curata.functions.text import POST_MAX, url_key
from curata.operators.dedup import keep_first, one_folder, pending_written, with_url_norm
from curata.operators.generate import SUMMARY_TEMPLATE
from curata.operators.publish import PUBLISHED
from curata.operators.repeats import cache_state
from curata.plans.curate import REPEATED, article_cache, generated
from curata.session import cut_lineage, drop_staged
from curata.sources.readers import exists
from curata.sources.sinks import LEDGER_COLUMNS, append_ledger, ledger_rows


def _published(spark: SparkSession, path: str) -> DataFrame:
    """The keys of the ledger; a ledger that isn't there yet has none.  Any other trouble
    with reading it raises: taken for an empty ledger it would publish everything again."""
    if not exists(spark, path):
        return spark.createDataFrame([], "url_norm string")
    return spark.read.parquet(path).select("url_norm")


def _version(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/v={batch_id}"


def _with_retries(df: DataFrame, batch_id: int, path: str) -> DataFrame:
    """The batch's rows and those that the last version before it holds."""
    spark = df.sparkSession
    before = [v for v in _versions(spark, path) if v < batch_id]
    if not before:
        return df
    return df.unionByName(spark.read.schema(df.schema).parquet(_version(path, max(before))))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions; a batch or two are there at a time."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [int(f.getPath().getParent().getName().split("=")[1]) for f in fs.globStatus(hpath(f"{path.rstrip('/')}/v=*/_SUCCESS")) or []]


def _write_retries(rows: DataFrame, batch_id: int, path: str) -> None:
    """This batch's version; versions older than the one it read go."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(_version(path, batch_id))
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    before = [v for v in _versions(spark, path) if v < batch_id]
    for v in before:
        if v != max(before):
            old = hpath(_version(path, v))
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def process_batch(df: DataFrame, batch_id: int, ledger_path: str, results_path: str,
                  generator: Callable[[str], str], template: str = SUMMARY_TEMPLATE,
                  length: int = POST_MAX, folder_col: str = "title",
                  workers: Sequence[str] | None = None,
                  prepare: Callable[[DataFrame], DataFrame] | None = None,
                  retry_path: str | None = None, cache_path: str | None = None, now=None) -> None:
    """One micro-batch (also usable as a plain batch run with any ``batch_id``).

    ``prepare`` adds the ``body`` column after dedup and the ledger anti join
    (e.g. main text from ``html``), so costly extraction only runs on what is new; a row that it
    leaves without body is ``failed``.  With ``retry_path`` unpublished rows come up again, and
    with ``cache_path`` the cache as it stands at ``now`` (the batch's time, if none is given) decides."""
    spark = df.sparkSession
    rows = df if retry_path is None else _with_retries(df, batch_id, retry_path)
    kept = cut_lineage(keep_first(with_url_norm(rows), [folder_col]))
    # The pending set is computed once (a written table under the checkpoint
    # folder): it is tested for emptiness, fed to generation, and what is left of it comes up again.
    waiting = cut_lineage(pending_written(kept, _published(spark, ledger_path)))
    drop_staged(kept)
    if waiting.isEmpty():
        if retry_path is not None:
            _write_retries(waiting.select(*df.columns), batch_id, retry_path)
        drop_staged(waiting)
        return
    staged = one_folder(waiting, order=(folder_col,))
    again = None
    if cache_path is not None:
        now = now or spark.sql("SELECT cast(current_timestamp() AS timestamp_ntz)").first()[0]
        cache = article_cache(spark, cache_path, batch_id)
        touched = cache.touched(staged.select(url_key("url").alias("url_key")))
        seen = cut_lineage(cache_state(staged, cache.read(touched).select("url_key", "fetched_at"), now).select(*staged.columns, "action"))
        again = seen.where(F.col("action") == REPEATED).select(*staged.columns, F.lit(REPEATED).alias("status"))
        staged = seen.where(F.col("action") != REPEATED).drop("action")
    # Python-heavy from here on: spread the rows by a key unique per row.  A
    # ``prepare`` that joins a large table should spread again after its join.
    todo = staged.repartition(spark.sparkContext.defaultParallelism, F.xxhash64(folder_col, "url_norm"))
    if prepare is not None:
        todo = prepare(todo)
    res = generated(todo, generator, template, length, workers)
    if again is not None:
        res = res.unionByName(again, allowMissingColumns=True)
    res = res.withColumn("batch_id", F.lit(batch_id))
    res.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(results_path)
    written = spark.read.parquet(results_path).where(F.col("batch_id") == batch_id)
    if again is not None:
        got = written.where(F.col("body").isNotNull() & (F.col("status") != REPEATED))
        cache.write(got.select(url_key("url").alias("url_key"), "url", F.lit(now).cast("timestamp_ntz").alias("fetched_at"), "body"), touched)
        drop_staged(seen)
    published = written.where(F.col("status") == PUBLISHED)
    # A retried batch must not append twice: skip keys already in the ledger.
    fresh = pending_written(published, _published(spark, ledger_path))
    append_ledger(ledger_rows(fresh, folder_col).select(*LEDGER_COLUMNS), ledger_path)
    if retry_path is not None:
        _write_retries(pending_written(waiting, _published(spark, ledger_path)).select(*df.columns), batch_id, retry_path)
    drop_staged(waiting)


def publish_stream(articles: DataFrame, ledger_path: str, results_path: str, checkpoint: str,
                   generator: Callable[[str], str], trigger: dict | None = None, **kw) -> StreamingQuery:
    """Start T2 over a streaming DataFrame of ``(title, item_id, url, updated, body)``."""
    w = (articles.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, ledger_path, results_path, generator, **kw))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
