"""Batch generation over a table (G1-G4) and its request/response columns.

The reference sends each article to a text-generation service and times the
call.  Here the service is a user-supplied Python callable, run inside
``mapInArrow`` so that Spark schedules the calls: concurrency is the number of
partitions (``workers`` repartitions to one partition per worker, the
reference's one worker per host), and a failing row becomes a ``status``
instead of stopping the job.  No model or network exists in this repository.

Call the generator once: persist or write the result of ``batch_generate``
before splitting it into published / rejected / error rows.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.batches import parts
from curata.functions.durations import elapsed_text
from curata.functions.text import EMPTY_FALLBACK

# The summary prompt of the reference (placeholders expanded here),
# the tagline prompt, and the slow-call threshold in seconds.
SUMMARY_TEMPLATE = (
    "Respond ONLY with the {length}-character summary. No thinking output. Summary: "
    "Provide a concise summary of this article in exactly {length} characters or less (including spaces). \n"
    "Focus on key points and policy implications if any.\n\n{body}")
TAGLINE_TEMPLATE = (
    "Generate exactly one complete, concise sentence (20-40 words, under 280 characters) "
    "summarizing the main point of the article at {url}. Content: {body}")
SLOW_AFTER_S = 30.0

#: What ``error`` says of a row that has nothing to be generated from.
NO_PROMPT = "no page, so no prompt"

OK, FAILED, INVALID, EMPTY = "ok", "failed", "invalid_response", "empty"

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def build_prompt(template: str, **parts) -> Column:
    """P12. Expand ``{name}`` placeholders with columns or literals, JVM-side.

    ``build_prompt(SUMMARY_TEMPLATE, length=F.lit(257), body=F.col("body"))``."""
    pieces: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            pieces.append(F.lit(template[pos:m.start()]))
        v = parts[m.group(1)]
        pieces.append((v if isinstance(v, Column) else F.lit(v)).cast("string"))
        pos = m.end()
    if pos < len(template):
        pieces.append(F.lit(template[pos:]))
    return F.concat(*pieces)


def request_json(model, prompt) -> Column:
    """P13. ``{"model": ..., "prompt": ..., "stream": false}``."""
    m = model if isinstance(model, Column) else F.lit(model)
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.to_json(F.struct(m.alias("model"), p.alias("prompt"), F.lit(False).alias("stream")))


def parse_response(c, field: str = "response") -> Column:
    """P14. Struct ``(text, status)`` from a JSON reply: the field as text when it
    is present and neither null nor false; malformed JSON, a non-object, or a
    missing/null/false field give status ``invalid_response``."""
    raw = F.col(c) if isinstance(c, str) else c
    v = F.try_parse_json(raw)
    val = F.try_variant_get(v, f"$.{field}", "variant")
    kind = F.schema_of_variant(val)
    ok = val.isNotNull() & ~kind.isin("NULL", "VOID") & ~((kind == "BOOLEAN") & ~F.try_variant_get(val, "$", "boolean"))
    text = F.when(ok, F.try_variant_get(val, "$", "string"))
    return F.struct(text.alias("text"), F.when(ok, F.lit(OK)).otherwise(F.lit(INVALID)).alias("status"))


def finish_text(c, fallback: str = EMPTY_FALLBACK) -> Column:
    """P15 + status: struct ``(text, status)``; empty text becomes the fallback, status ``empty``."""
    x = F.col(c) if isinstance(c, str) else c
    empty = x.isNull() | (F.regexp_replace(x, r"(?U)\s", "") == "")
    return F.struct(F.when(empty, F.lit(fallback)).otherwise(x).alias("text"),
                    F.when(empty, F.lit(EMPTY)).otherwise(F.lit(OK)).alias("status"))


def filter_models(models: DataFrame, skip: Sequence[str], col: str = "model") -> DataFrame:
    """F7. Drop names matching any skip entry as an unanchored regex; empty list keeps all."""
    if not skip:
        return models
    return models.where(~F.col(col).rlike("|".join(skip)))


def batch_generate(df: DataFrame, generator: Callable[..., str], prompt: str = "prompt",
                   extra_args: Sequence[str] = (), workers: Sequence[str] | None = None,
                   slow_after_s: float = SLOW_AFTER_S) -> DataFrame:
    """G1 + G3 + G4. Adds ``raw`` (string), ``duration_s`` (double), ``worker``,
    ``status`` (``ok`` / ``failed``) and ``slow`` (bool) to every row.

    ``generator(prompt, *extra_args)`` is called once per row; exceptions become
    ``status = failed`` with the message in ``error``.  A row without a prompt (an article
    without a page) is ``failed`` without a call.  With ``workers`` the rows
    are spread over one partition per worker and ``worker`` names it.  A worker holds about a
    megabyte of prompts and answers as Python strings, whatever the size of a batch."""
    generated = ("raw", "duration_s", "worker", "status", "error", "slow")
    df = df.drop(*[c for c in generated if c in df.columns])
    if workers:
        df = df.repartition(len(workers))
    names = list(workers) if workers else None
    schema = T.StructType(df.schema.fields + [
        T.StructField("raw", T.StringType()), T.StructField("duration_s", T.DoubleType()),
        T.StructField("worker", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()), T.StructField("slow", T.BooleanType())])
    extra = list(extra_args)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        worker = names[pid % len(names)] if names else f"task-{pid}"
        for b in (whole.slice(lo, hi - lo) for whole in batches for lo, hi in parts(whole.column(prompt))):
            raws, secs, stats, errs = [], [], [], []
            for row in zip(*(b.column(c).to_pylist() for c in (prompt, *extra))):
                t0 = time.perf_counter()
                try:
                    if row[0] is None:
                        raise LookupError(NO_PROMPT)
                    out = generator(*row)
                    raws.append(None if out is None else str(out))
                    stats.append(OK)
                    errs.append(None)
                except Exception as e:  # noqa: BLE001 - one bad row must not stop the rest
                    raws.append(None)
                    stats.append(FAILED)
                    errs.append(f"{type(e).__name__}: {e}")
                secs.append(time.perf_counter() - t0)
            added = [pa.array(raws, pa.string()), pa.array(secs, pa.float64()), pa.array([worker] * len(secs), pa.string()),
                     pa.array(stats, pa.string()), pa.array(errs, pa.string()), pa.array([x > slow_after_s for x in secs], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], [*b.schema.names, *generated])

    return df.mapInArrow(run, schema)


#: Rows of a journal's bucket, about: what a lost task generates again.
ROWS_A_BUCKET = 1000


def journaled_generate(df: DataFrame, generator: Callable[..., str], journal: str, keys: Sequence[str], prompt: str = "prompt",
                       extra_args: Sequence[str] = (), workers: Sequence[str] | None = None, slow_after_s: float = SLOW_AFTER_S,
                       rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """``batch_generate`` that can be resumed: rows that a run has written are not generated again.

    Rows fall into hash buckets of ``keys`` of about ``rows_a_bucket`` rows, whatever the number of workers or
    cores, and a bucket is a file of the table ``journal``.  A task's files take their place as
    soon as it ends (the committer's version 2), so what a killed job had finished stays.  The
    next run with the same input generates only the buckets that are missing; those that were
    under way start anew.  A journal belongs to one input: ``keys`` name its rows."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(journal).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    meta, data = f"{journal.rstrip('/')}/meta", f"{journal.rstrip('/')}/data"
    if fs.exists(path(f"{meta}/_SUCCESS")):
        buckets = spark.read.parquet(meta).first()["buckets"]
    else:
        buckets = max(1, -(-df.count() // rows_a_bucket))
        spark.createDataFrame([(buckets,)], "buckets long").coalesce(1).write.mode("overwrite").parquet(meta)
    done = [int(f.getPath().getName().split("=")[1]) for f in fs.globStatus(path(f"{data}/_bucket=*")) or []
            if fs.globStatus(path(f"{f.getPath()}/part-*"))]
    todo = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    if done:  # a number a bucket
        finished = spark.createDataFrame([(b,) for b in done], "_bucket int")
        todo = todo.join(F.broadcast(finished), "_bucket", "left_anti")
    out = batch_generate(todo.repartition(buckets, "_bucket"), generator, prompt, extra_args, None, slow_after_s)
    if workers:
        names = F.array(*map(F.lit, workers))
        out = out.withColumn("worker", F.get(names, F.col("_bucket") % len(workers)))
    if len(done) < buckets:
        out.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("_bucket").parquet(data)
    columns = [c for c in out.columns if c != "_bucket"]
    return spark.read.schema(out.select(*columns, "_bucket").schema).parquet(data).select(*columns)


def sweep(articles: DataFrame, models: Sequence[str], generator: Callable[[str, str], str],
          prompt: str = "prompt", skip: Sequence[str] = ()) -> DataFrame:
    """G2 (+ J4, F7, P8). Every listed model over every article, timed.

    The model list is a parameter (what a service lists); each article row is
    expanded with ``explode`` over that list, so no join and no shuffle is needed.  ``generator(prompt, model)``."""
    names = sorted(m for m in models if not (skip and re.search("|".join(skip), m)))
    if not names:
        return batch_generate(articles.withColumn("model", F.lit(None).cast("string")).where(F.lit(False)),
                              generator, prompt, ["model"])
    expanded = articles.withColumn("model", F.explode(F.array(*[F.lit(n) for n in names])))
    out = batch_generate(expanded, generator, prompt, ["model"])
    return out.withColumn("elapsed", elapsed_text(F.floor("duration_s")))
