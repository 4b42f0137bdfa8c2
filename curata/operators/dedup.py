"""URL dedup: F2 valid URLs, W1 keep-first per normal form, J3 not yet published.

Keep-first is a ``max_by`` aggregate rather than a ranking window: it combines
on the map side (partial aggregation), so a URL that is popular across many
items costs one partial row per map task instead of a sort of every copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.text import normalize_url


def with_url_norm(df: DataFrame, url_col: str = "url") -> DataFrame:
    """P1 + F2. Add ``url_norm``; drop null/empty URLs and empty normal forms."""
    return (df.where(F.col(url_col).isNotNull() & (F.col(url_col) != ""))
            .withColumn("url_norm", normalize_url(url_col))
            .where(F.col("url_norm") != ""))


def keep_first(df: DataFrame, group: Sequence[str], key: str = "url_norm",
               order: str = "updated", tie: str = "item_id") -> DataFrame:
    """W1. For each ``group + key`` keep the row with the latest ``order`` (nulls
    lose), ties broken by the lowest ``tie``.  The reference leaves ties to the
    database's row order; we make them deterministic."""
    keys = list(group) + [key]
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(F.col(order).alias("o"), (-F.col(tie)).alias("t"))
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in rest])


def pending(df: DataFrame, published_keys: DataFrame, key: str = "url_norm") -> DataFrame:
    """J3. Rows whose normal form is not in the ledger (one ledger for all folders).

    A plain left-anti join: AQE picks broadcast-hash when the ledger keys turn
    out small at run time and sort-merge otherwise, and splits skewed keys."""
    return df.join(published_keys.select(key), key, "left_anti")


#: Pending keys up to which they go to the ledger's rows; beyond, both sides are shuffled.
MOST_SENT = 2_000_000


def pending_written(df: DataFrame, published_keys: DataFrame, key: str = "url_norm", most: int = MOST_SENT) -> DataFrame:
    """J3 for a written table of pending rows, which stay few while the ledger grows.

    The pending keys are sent to where the ledger lies, which is scanned for hits and not shuffled;
    the rows are then held against the hits alone.  ``published_keys`` needs not be distinct.  More
    than ``most`` pending rows are joined as in ``pending``."""
    if df.count() > most:
        return pending(df, published_keys, key)
    hits = published_keys.select(key).join(F.broadcast(df.select(key)), key, "left_semi")
    return pending(df, hits, key)


def one_folder(df: DataFrame, key: str = "url_norm", order: Sequence[str] = ("title", "node_id")) -> DataFrame:
    """One row a URL: its first folder by ``order``.  An aggregate, as W1."""
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_first")
    return df.groupBy(key).agg(first).select(*[F.col(key) if c == key else F.col("_first")[c].alias(c) for c in df.columns])
