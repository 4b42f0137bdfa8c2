"""Curate every saved search in one job.

``folders -> membership -> items -> url_norm -> keep-first -> not in ledger -> one folder
a URL -> (cache) -> page text -> prompt -> generate -> trace removal -> fallback -> clean -> gate``

Shuffles: the membership/items join, the keep-first aggregate, the ledger anti join and the
choice of a folder (AQE picks the strategies at run time); the page join brings the HTML
only for the URLs that survive, once a URL.  The anti join sits below generation on
purpose: Catalyst does not move joins across ``mapInPandas``, so the generator never sees a
published URL.  A URL is generated once, whatever the number of its folders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.html import main_text, page_text
from curata.functions.text import POST_MAX, char_count, clean_text, url_key
from curata.functions.traces import strip_trace
from curata.operators.dedup import keep_first, one_folder, pending_written, with_url_norm
from curata.operators.folders import folder_items, saved_searches
from curata.operators.generate import OK, SUMMARY_TEMPLATE, batch_generate, build_prompt, finish_text, journaled_generate
from curata.operators.publish import PUBLISHED, classify
from curata.operators.repeats import cache_state, merge_cache
from curata.session import cut_lineage
from curata.sources.readers import ledger_norms
from curata.streaming.buckets import Buckets

#: Statuses of rows that are not generated in this run.
ALREADY_PUBLISHED, DEFERRED, REPEATED = "already_published", "deferred", "repeated"


def generated(art: DataFrame, generator: Callable[[str], str], template: str = SUMMARY_TEMPLATE,
              length: int = POST_MAX, workers: Sequence[str] | None = None,
              error_substring: bool = True, journal: str | None = None) -> DataFrame:
    """P12 -> G1 -> P3 -> P15 -> P2 -> F5 over rows with ``body`` (and ``url`` for templates
    that name it).  ``empty``, ``failed`` and ``invalid_response`` stay statuses of their own; a row
    without body is ``failed`` and not sent.  With ``journal`` (a path) the run can be resumed."""
    art = art.withColumn("prompt", build_prompt(template, length=length, body=F.col("body"), url=F.col("url")))
    if journal is None:
        gen = batch_generate(art, generator, "prompt", workers=workers)
    else:
        gen = journaled_generate(art, generator, journal, ["url_norm"], "prompt", workers=workers)
    gen = gen.withColumn("_clean", strip_trace("raw"))  # its own column: computed once per row
    out = (gen.withColumn("_fin", finish_text("_clean"))
           .withColumn("promotion", F.when(F.col("status") == OK, clean_text(F.col("_fin.text"))).otherwise(F.lit("")))
           .withColumn("status", F.when(F.col("status") == OK, F.col("_fin.status")).otherwise(F.col("status")))
           .drop("_fin", "_clean", "prompt"))
    out = classify(out, "promotion", error_substring=error_substring)
    return (out.withColumn("n_chars", char_count("promotion"))
            .withColumn("over_length", F.col("n_chars") > length))


def curate(node: DataFrame, membership: DataFrame, items: DataFrame, ledger: DataFrame,
           pages: DataFrame, generator: Callable[[str], str], template: str = SUMMARY_TEMPLATE,
           length: int = POST_MAX, workers: Sequence[str] | None = None,
           error_substring: bool = True, body: Column | None = None, body_limit: int | None = None,
           cache: DataFrame | None = None, now=None, on_fresh: str = "flag",
           parallelism: int | None = None, journal: str | None = None) -> DataFrame:
    """Rows ``node_id, title, item_id, url, url_norm, body, raw, promotion, status,
    n_chars, over_length, duration_s, worker, slow`` for every URL of every saved search
    not yet in ``ledger`` (one row per folder and normal form; newest item wins).

    Each URL is generated for one folder, the first by ``(title, node_id)``; its rows in other
    folders come out as ``already_published`` when it was, else as ``deferred``: an error
    or a reject comes up again in the next run.

    ``items`` must carry ``page_id`` to find the page in ``pages(page_id, html)``; an article without
    a page is ``failed`` and comes up again in the next run.  The body is the
    whole main text unless ``body`` or ``body_limit`` says otherwise.  With ``cache`` (one row a
    key, optionally with ``body``) a fresh hit is ``repeated`` and not generated, or, with
    ``on_fresh="reuse"``, uses the cached body.  The result is written once."""
    fi = folder_items(saved_searches(node), membership, items)
    kept = cut_lineage(keep_first(with_url_norm(fi), ["node_id"]))
    todo = cut_lineage(pending_written(kept, ledger_norms(ledger)))
    chosen = one_folder(todo)
    if cache is not None:
        chosen = cache_state(chosen, cache, now, on_fresh)
        again = chosen.where(F.col("action") == REPEATED)
        fresh = chosen.where(F.col("action") == "reuse") if "body" in cache.columns else None
        chosen = chosen.where(F.col("action").isin("fetch", "refresh") | (F.lit(fresh is None) & (F.col("action") == "reuse")))
        plain = [c for c in todo.columns]
    # Python does the heavy part from here on (HTML, then generation, which costs
    # far more per row than moving it): spread the surviving articles evenly over
    # the tasks by a key that is unique per row (deterministic on retry).  The
    # hash *expression* matters: a plain repartition on url_norm would be dropped
    # as already satisfied, and AQE would coalesce it to a few partitions.
    spread = parallelism or todo.sparkSession.sparkContext.defaultParallelism
    text = main_text("html", limit=body_limit) if body is None else body
    art = (chosen.select(*todo.columns).join(pages.select("page_id", "html"), "page_id", "left")
           .repartition(spread, F.xxhash64("node_id", "url_norm"))
           .withColumn("body", F.when(F.col("html").isNotNull(), text)).drop("html"))
    if cache is not None and fresh is not None:
        art = art.unionByName(fresh.select(*plain, "body"))
    done = cut_lineage(generated(art, generator, template, length, workers, error_substring, journal))
    if cache is not None:
        done = done.unionByName(again.select(*plain, F.lit(REPEATED).alias("status")), allowMissingColumns=True)
    other = (todo.join(done.select("url_norm", F.col("node_id").alias("_n"), F.col("status").alias("_s")), "url_norm")
             .where(F.col("node_id") != F.col("_n"))
             .withColumn("status", F.when(F.col("_s") == PUBLISHED, F.lit(ALREADY_PUBLISHED)).otherwise(F.lit(DEFERRED)))
             .drop("_n", "_s"))
    return done.unionByName(other, allowMissingColumns=True)


def refreshed_cache(pages: DataFrame, cache: DataFrame, now, limit: int | None = None) -> DataFrame:
    """J5 + S11 + X3. The next cache snapshot ``(url_key, url, fetched_at, body)``: fresh rows
    as they are, stale and new ones fetched from ``pages(url, html)`` at ``now``."""
    state = cache_state(pages.select("url", "html").dropDuplicates(["url"]), cache.select("url_key", "fetched_at"), now)
    fetched = (state.where(F.col("action") != REPEATED)
               .select("url_key", "url", F.lit(now).cast(cache.schema["fetched_at"].dataType).alias("fetched_at"),
                       main_text("html", limit=limit).alias("body")))
    return merge_cache(cache, cut_lineage(fetched))


CACHE_SCHEMA = T.StructType([T.StructField("url_key", T.StringType()), T.StructField("url", T.StringType()),
                             T.StructField("fetched_at", T.TimestampNTZType()), T.StructField("body", T.StringType())])


def article_cache(spark: SparkSession, path: str, batch_id: int, buckets: int | None = None) -> Buckets:
    """The article cache as a bucketed table, as batch ``batch_id`` meets it."""
    return Buckets(spark, path, batch_id, CACHE_SCHEMA, "url_key", "fetched_at", buckets)


def upsert_cache(pages: DataFrame, cache: Buckets, now, limit: int | None = None) -> None:
    """S11 + X3 incrementally: of ``pages(url, html)``, new and stale ones are fetched at ``now`` and
    written to their buckets; nothing else of the cache is read or written."""
    rows = pages.select("url", "html").dropDuplicates(["url"])
    touched = cache.touched(rows.select(url_key("url").alias("url_key")))
    state = cache_state(rows, cache.read(touched).select("url_key", "fetched_at"), now)
    cache.write(state.where(F.col("action") != REPEATED).select(
        "url_key", "url", F.lit(now).cast("timestamp_ntz").alias("fetched_at"), main_text("html", limit=limit).alias("body")), touched)


def whole_page(html: str = "html") -> Column:
    """P23 as the body of ``curate``: all visible text of the page."""
    return page_text(html)


# --------------------------------------------------------------------------- test generator
# Fixed behaviour of the deterministic stand-in for a model (also written in SQL
# in the catalog): the body is what follows the first blank line of the prompt.
def digest_generator(prompt: str) -> str:
    body = prompt.split("\n\n", 1)[1] if "\n\n" in prompt else prompt
    n = len(body)
    if n % 11 == 0:
        return "Error: generation failed"
    if n % 7 == 0:
        return "Reject: not news"
    digest = hashlib.md5(body.encode("utf-8")).hexdigest()[:12]
    return f"<think>\nweighing {n} characters\n</think>\nSummary {digest} of {n} characters."
