"""Stand-in inputs built from the driver tables (FIXTURES.md section 3).

The reference reads a feed reader's folder tables, a CSV ledger and generated
text; the driver ships TPC-H-like tables instead.  Each function here derives
one of those inputs from the driver tables with Spark, and ``SQL_CTES`` holds
the same definitions for DuckDB so the oracle sees identical inputs.  Every
stand-in grows with the tables it is built from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.sources.tables import Tables

# Fixed parameters of the stand-ins.
NOW = "2024-01-31 00:00:00"          # the cache's "now"
EXAMPLE_URL = "https://example.org/"  # promotion URLs: EXAMPLE_URL || doc_id
UTM_SUFFIX = "?utm_campaign=x"
MODEL_SKIP = ["small", "old"]


def page_count(t: Tables) -> Column:
    """Number of pages as a scalar subquery (planned by Spark, not collected)."""
    return t.pages.select(F.count(F.lit(1))).scalar()


def node(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    title = F.concat(F.col("n_name"),
                     F.when(k % 2 == 0, F.lit(" Saved Search"))
                     .when(k % 5 == 0, F.lit(" saved search"))
                     .otherwise(F.lit(" Inbox")))
    kind = F.when(k % 7 == 3, F.lit("folder")).otherwise(F.lit("vfolder"))
    own = t.nation.select(k.alias("node_id"), title.alias("title"), kind.alias("type"))
    # folders without any item
    empty = t.nation.select((k + 1000).alias("node_id"), F.concat("n_name", F.lit(" Empty Saved Search")).alias("title"),
                            F.lit("vfolder").alias("type"))
    return own.unionByName(empty)


def membership(t: Tables) -> DataFrame:
    n = page_count(t)
    c = t.customer
    a = c.select(F.col("c_nationkey").alias("node_id"), (F.col("c_custkey") % n).alias("item_id"))
    b = c.select(F.col("c_nationkey").alias("node_id"), (F.col("c_custkey") % n + n).alias("item_id"))
    return a.unionByName(b).distinct()


def items(t: Tables) -> DataFrame:
    """Items with a ``source`` URL column (so URL-column resolution must find it)."""
    n = page_count(t)
    ev = t.events.select("event_id", F.col("ts").alias("updated"))
    p = t.pages.select("page_id", "url")
    first = p.select(
        F.col("page_id").alias("item_id"), "page_id",
        F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "^http://", "https://www."))
        .otherwise(F.col("url")).alias("source"))
    variant = (p.where(~F.col("url").contains("?") & ~F.col("url").contains("#"))
               .select((F.col("page_id") + n).alias("item_id"), "page_id",
                       F.concat("url", F.lit(UTM_SUFFIX)).alias("source")))
    both = first.unionByName(variant)
    return both.join(ev, both.item_id == ev.event_id, "left").drop("event_id")


def ledger(t: Tables) -> DataFrame:
    """Already-published URLs: every other page."""
    return t.pages.where(F.col("page_id") % 2 == 0).select("url")


def fetched(t: Tables) -> DataFrame:
    """Pages as far as they could be fetched: one in ten is missing."""
    return t.pages.where(F.col("page_id") % 10 != 7)


def raw_outputs(t: Tables) -> DataFrame:
    """Model output with a reasoning block before the answer."""
    raw = F.concat(F.lit("<think>\n"), F.col("text"), F.lit("\n</think>\n"), F.col("text"))
    return t.conversations.select("conv_id", "turn", raw.alias("raw"))


def promotions(t: Tables) -> DataFrame:
    """Promotion rows (promotion, url, folder_name) from documents, whole texts."""
    return t.documents.select(
        "doc_id",
        F.col("text").alias("promotion"),
        F.concat(F.lit(EXAMPLE_URL), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("folder_name"))


def outcome_mix(t: Tables) -> DataFrame:
    """Generated text, and as further rows rejects, errors and empty results."""
    d = t.documents.select("doc_id", F.col("source").alias("folder"), F.col("text").alias("promotion"))
    k = F.col("doc_id")
    extra = (F.when(k % 13 == 0, F.lit("")).when(k % 11 == 0, F.concat(F.lit("Error: "), "promotion"))
             .when(k % 7 == 0, F.concat(F.lit("Reject: "), "promotion")))
    more = d.withColumn("promotion", extra).where((k % 13 == 0) | (k % 11 == 0) | (k % 7 == 0))
    return d.unionByName(more)


def reconcile_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Left = CSV side (padding spaces, some rows twice), right = table side."""
    p = promotions(t)
    d = F.col("doc_id")
    left = p.where(d % 10 != 1).select(
        d, F.concat(F.lit("  "), F.col("promotion"), F.lit(" ")).alias("promotion"),
        F.concat(F.col("url"), F.lit(" ")).alias("url"))
    twice = left.where(d % 3 == 0)
    right = p.where(d % 10 != 2).select(d, "promotion", "url")
    return left.unionByName(twice).drop("doc_id"), right.drop("doc_id")


def models(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_name").alias("model")).distinct()


def cache(t: Tables) -> DataFrame:
    """Article cache: one entry per user, keyed by md5 of that user's page URL."""
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("fetched_at"))
    pages = t.pages.select("page_id", "url")
    return (first.join(pages, first.user_id == pages.page_id)
            .select(F.md5("url").alias("url_key"), "url", "fetched_at"))


# ---------------------------------------------------------------------------
# The same stand-ins in DuckDB SQL (used by oracle_sql).  Each is a CTE body.
SQL_CTES = {
    "npages": "SELECT count(*) AS n FROM pages",
    "node": """SELECT n_nationkey AS node_id,
        n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' Saved Search'
                       WHEN n_nationkey % 5 = 0 THEN ' saved search' ELSE ' Inbox' END AS title,
        CASE WHEN n_nationkey % 7 = 3 THEN 'folder' ELSE 'vfolder' END AS type FROM nation
        UNION ALL SELECT n_nationkey + 1000, n_name || ' Empty Saved Search', 'vfolder' FROM nation""",
    "sfi": """SELECT c_nationkey AS node_id, c_custkey % n AS item_id
                FROM customer, npages
              UNION
              SELECT c_nationkey AS node_id, c_custkey % n + n AS item_id
                FROM customer, npages""",
    "items": """SELECT b.item_id, b.page_id, b.source, e.ts AS updated FROM (
          SELECT page_id AS item_id, page_id,
                 CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, '^http://', 'https://www.') ELSE url END AS source
            FROM pages
          UNION ALL
          SELECT page_id + n AS item_id, page_id, url || '?utm_campaign=x' AS source
            FROM pages, npages WHERE strpos(url, '?') = 0 AND strpos(url, '#') = 0
        ) b LEFT JOIN events e ON e.event_id = b.item_id""",
    "fetched": "SELECT * FROM pages WHERE page_id % 10 <> 7",
    "ledger": "SELECT url FROM pages WHERE page_id % 2 = 0",
    "promotions": """SELECT doc_id, text AS promotion, 'https://example.org/' || CAST(doc_id AS VARCHAR) AS url,
        source AS folder_name FROM documents""",
}


def sql_with(*names: str) -> str:
    """``WITH`` clause holding the named stand-ins and what they depend on."""
    deps = {"sfi": ["npages"], "items": ["npages"]}
    order: list[str] = []

    def add(n):
        for d in deps.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({SQL_CTES[n]})" for n in order) + "\n"
