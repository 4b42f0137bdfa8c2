"""Sinks: ledger (S7), per-folder export (S8), sweep log (S10), promotions load (S9 lives in reconcile).

The ledger of record is a Parquet table appended per run; the CSV export keeps
the reference's dialect (every field quoted, backslash escape, two-decimal
seconds) for tools that read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.durations import seconds_text
from curata.functions.text import clean_text, slug

LEDGER_COLUMNS = ("promotion", "url", "folder_name", "duration_s", "worker", "url_norm")
# The ledger CSV header (the last column names the worker host).
LEDGER_HEADER = ("Promotion", "URL", "Search Folder Name", "Duration (Seconds)", "Host")


def ledger_rows(published: DataFrame, folder_col: str = "title") -> DataFrame:
    """Published rows in ledger shape, with the key they are found by later: the normal
    form of the URL as it came.  (Only the CSV export cleans the URL.)"""
    return published.select(
        F.col("promotion"), F.col("url"), F.col(folder_col).alias("folder_name"),
        F.col("duration_s").cast("double"), F.col("worker"), F.col("url_norm"))


def append_ledger(rows: DataFrame, path: str) -> None:
    """S7. Append to the Parquet ledger (created on first write)."""
    rows.select(*LEDGER_COLUMNS).write.mode("append").parquet(path)


def export_ledger_csv(ledger: DataFrame, path: str) -> None:
    """S7 export: header, every field quoted, ``\\`` escapes quotes, seconds as text; the URL
    is written through ``clean_text``."""
    out = ledger.select(
        F.col("promotion").alias(LEDGER_HEADER[0]), clean_text("url").alias(LEDGER_HEADER[1]),
        F.col("folder_name").alias(LEDGER_HEADER[2]), seconds_text("duration_s").alias(LEDGER_HEADER[3]),
        F.col("worker").alias(LEDGER_HEADER[4]))
    (out.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("escape", "\\").csv(path))


class SlugCollisionError(ValueError):
    pass


def export_folders(urls: DataFrame, path: str, folder_col: str = "title", url_col: str = "url",
                   updated_col: str = "updated", tie: str = "item_id") -> None:
    """S8 + O2. CSV files per folder (directory ``folder_slug=<slug>``), header ``URL``, every
    field quoted, quotes doubled; all folders in one job, overwritten.

    Rows come in ``updated DESC`` order (nulls last, ties by item): a range split over
    (folder, order) lets a large folder fill several files, whose names sort as their
    rows do.  Two folders with one slug fail the export before anything is written."""
    out = urls.select(slug(folder_col).alias("folder_slug"), F.col(folder_col).alias("_f"), F.col(url_col).alias("URL"),
                      F.col(updated_col).alias("_u"), F.col(tie).alias("_i"))
    clash = out.groupBy("folder_slug").agg(F.min("_f").alias("a"), F.max("_f").alias("b")).where("a <> b").first()
    if clash:
        raise SlugCollisionError(f"folders {clash['a']!r} and {clash['b']!r} share the slug {clash['folder_slug']!r}")
    order = [F.col("folder_slug"), F.col("_u").desc_nulls_last(), F.col("_i")]
    n = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartitionByRange(n, *order).sortWithinPartitions(*order).select("folder_slug", "URL")
    (out.write.mode("overwrite").partitionBy("folder_slug").option("header", True)
     .option("quoteAll", True).option("escape", '"').csv(path))


def append_sweep_log(results: DataFrame, path: str) -> None:
    """S10. Sweep results ``(model, url, summary, n_chars, elapsed_s, elapsed, status)``."""
    results.select("model", "url", F.col("raw").alias("summary"), F.length("raw").cast("long").alias("n_chars"),
                   F.col("duration_s").alias("elapsed_s"), "elapsed", "status").write.mode("append").parquet(path)
