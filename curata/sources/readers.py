"""Sources: subscriptions (OPML), feed list, ledger CSV, promotions CSV, URL column.

S1 ``read_opml``, S2 ``read_feed_list``, S4 ``resolve_url_column``, S5
``read_ledger`` / ``ledger_keys``, S6 ``read_promotions`` (+ P5 folder from the
file name, F3 arity).  Every reader returns a lazy DataFrame; a missing ledger
is an empty DataFrame, not an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.text import folder_from_file_name, normalize_url, strip_ws
from curata.sources.records import read_csv

# URL column candidates in order; the OPML outline attributes.
URL_CANDIDATES = ("url", "source", "link", "guid")
OPML_ATTRS = ("title", "text", "description", "type", "xmlUrl", "htmlUrl")

LEDGER_SCHEMA = T.StructType([
    T.StructField("promotion", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("folder_name", T.StringType()),
    T.StructField("duration_s", T.StringType()),
    T.StructField("worker", T.StringType()),
])

PROMOTIONS_SCHEMA = T.StructType([
    T.StructField("promotion", T.StringType()),
    T.StructField("url", T.StringType()),
])

# A null marker that cannot occur in text, so an empty field reads as '' and
# only a missing field reads as null.
_NO_NULL = "\u0000curata-null\u0000"


def resolve_url_column(items: DataFrame, candidates: Sequence[str] = URL_CANDIDATES) -> DataFrame:
    """S4. The first of ``url, source, link, guid`` present in the schema, for the
    whole table, renamed ``url``.  None present -> no rows (same columns, empty)."""
    found = next((c for c in candidates if c in items.columns), None)
    if found is None:
        return items.withColumn("url", F.lit(None).cast("string")).where(F.lit(False))
    others = [c for c in items.columns if c not in candidates]
    return items.select(*others, F.col(found).cast("string").alias("url"))


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hpath))  # any other error raises


def read_opml(spark: SparkSession, path: str) -> DataFrame:
    """S1. One row per feed: ``folder, path, title, text, description, type, xmlUrl, htmlUrl``.

    The outermost ``outline`` elements are rows (the built-in XML source decodes
    entities); the walk goes down their child outlines as far as the data does.  ``path`` holds
    the titles (else the texts) of the folders around a feed, outermost first, and ``folder``
    the last of them.  An outline is a feed if it has an ``xmlUrl`` or no child outlines; one
    with both is a feed and a folder.  A top-level feed has no folder."""
    raw = (spark.read.format("xml").option("rowTag", "outline")
           .option("attributePrefix", "_").option("valueTag", "_value").load(path))
    level = raw.select(F.array().cast("array<string>").alias("path"), F.struct(*raw.columns).alias("o"))
    feeds = None
    while True:
        kind = level.schema["o"].dataType
        fields = set(kind.fieldNames())

        def attr(name: str):
            return F.col(f"o._{name}").cast("string") if f"_{name}" in fields else F.lit(None).cast("string")

        children = F.col("o.outline") if "outline" in fields else None
        leaf = F.lit(True) if children is None else children.isNull()
        own = level.where(leaf | attr("xmlUrl").isNotNull()).select(
            F.get("path", F.size("path") - 1).alias("folder"), "path", *[attr(a).alias(a) for a in OPML_ATTRS])
        feeds = own if feeds is None else feeds.unionByName(own)
        if children is None:
            return feeds
        inside = F.concat("path", F.array(F.coalesce(attr("title"), attr("text"))))
        below = level.where(children.isNotNull())
        # where no outline of a level has two children, a child is a plain struct
        many = isinstance(kind["outline"].dataType, T.ArrayType)
        level = below.select(inside.alias("path"), (F.explode(children) if many else children).alias("o"))


def read_feed_list(spark: SparkSession, path: str) -> DataFrame:
    """S2. One URL a line; surrounding whitespace trimmed, blank lines dropped."""
    return (spark.read.text(path)
            .select(strip_ws("value").alias("url"))
            .where(F.col("url") != ""))


def read_ledger(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """S5. The ledger CSV (header, every field quoted, backslash escape).
    Rows with fewer than two fields are dropped; a missing file is empty.  A file is read by
    many tasks (``sources.records``)."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = read_csv(spark, path, LEDGER_SCHEMA, "\\", _NO_NULL, split_bytes)
    return rows.where(F.col("url").isNotNull()).select(*LEDGER_SCHEMA.fieldNames())


def ledger_norms(ledger: DataFrame, url_col: str = "url") -> DataFrame:
    """The key of every ledger row: its stored ``url_norm``, or, for a ledger without one, the
    normal form of its URL."""
    if "url_norm" in ledger.columns:
        return ledger.select("url_norm")
    return ledger.select(normalize_url(url_col).alias("url_norm"))


def ledger_keys(ledger: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct keys of the ledger (the anti-join side of J3)."""
    return ledger_norms(ledger, url_col).distinct()


def read_promotions(spark: SparkSession, path: str, prefix: str | None = None,
                    escape: str = '"', with_position: bool = False, split_bytes: int | None = None) -> DataFrame:
    """S6 (+ P5, F3). Promotions CSV: header skipped, first two fields, short rows
    dropped, extra fields ignored.  With ``prefix`` the folder name is taken from
    the file name ``<prefix><folder>.csv``; other names fail the query.  With
    ``with_position`` the file's name and the row's number in it come along (``file_name``,
    ``position``).  A file is read by many tasks (``sources.records``)."""
    df = read_csv(spark, path, PROMOTIONS_SCHEMA, escape, _NO_NULL, split_bytes).where(F.col("url").isNotNull())
    columns = [*PROMOTIONS_SCHEMA.fieldNames(), *(["file_name", "position"] if with_position else [])]
    if prefix is not None:
        df = df.withColumn("folder_name", folder_from_file_name(F.col("file_name"), prefix))
        columns.append("folder_name")
    return df.select(*columns)
