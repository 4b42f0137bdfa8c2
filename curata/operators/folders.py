"""Folder operators: saved searches, counts, listing order, folder items.

F1 saved searches, J1 + A1 item counts (empty folders count 0), O1 + P24 ordered
listing with ordinals, J2 + O2 items of every folder with their URL column.
All folders are handled in one job (the reference asks for one folder at a time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.operators.ordering import ordinal
from curata.sources.readers import resolve_url_column

# The saved-search rule (SQLite LIKE ignores ASCII case).
SAVED_SEARCH_TYPE = "vfolder"
SAVED_SEARCH_TITLE = "%search%"


def saved_searches(node: DataFrame, title_pattern: str = SAVED_SEARCH_TITLE,
                   folder_type: str = SAVED_SEARCH_TYPE) -> DataFrame:
    """F1. ``type = 'vfolder' AND title ILIKE '%search%'``; pushed to the scan where possible."""
    return node.where((F.col("type") == folder_type) & F.col("title").ilike(title_pattern))


def folder_counts(node: DataFrame, membership: DataFrame, **kw) -> DataFrame:
    """J1 + A1. One row per saved search with ``n_items = count(item_id)`` (0 when empty).

    The membership side is pre-aggregated per ``node_id`` before the join, so the
    join sees one row per folder and a hot folder cannot skew it.
    """
    counts = membership.groupBy("node_id").agg(F.count("item_id").alias("n_items"))
    folders = saved_searches(node, **kw).select("node_id", "title")
    return (folders.join(counts, "node_id", "left")
            .select("node_id", "title", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items")))


def folder_listing(counts: DataFrame) -> DataFrame:
    """O1 + P24. Folders by title (binary order, ties by id) with 1-based ordinals."""
    return ordinal(counts, ["title", "node_id"], name="ordinal")


def folder_items(folders: DataFrame, membership: DataFrame, items: DataFrame,
                 url_candidates=("url", "source", "link", "guid")) -> DataFrame:
    """J2 (+ S4). Membership of the given folders joined to items, URL column resolved.

    Returns ``node_id, title, item_id, url, updated`` plus any other item columns.
    The listing order O2 (``updated`` desc, nulls last) is applied by ``ordered_items``.
    """
    resolved = resolve_url_column(items, url_candidates)
    m = membership.join(folders.select("node_id", "title"), "node_id")
    return m.join(resolved, "item_id")


def only_folder(folders: DataFrame, title: str) -> DataFrame:
    """F4. The folder with this very title; pushed to the scan."""
    return folders.where(F.col("title") == title)


def ordered_items(df: DataFrame) -> DataFrame:
    """O2. ``ORDER BY updated DESC`` with nulls last, ties by item id."""
    return df.orderBy(F.col("updated").desc_nulls_last(), F.col("item_id"))
