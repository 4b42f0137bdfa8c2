"""Publishing: F5 outcome gate, A4 run summary, F6/P17-P19 posts, W2 file order.

The ledger and folder-export sinks live in ``curata.sources.sinks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.text import POST_MAX, link_free_length, post_text, strip_ws

# Outcome words of the gate.
ERROR_WORD = "Error"
REJECT_PREFIX = "Reject:"
PUBLISHED, REJECTED, ERROR = "published", "rejected", "error"


def classify(df: DataFrame, col: str = "promotion", error_substring: bool = True,
             status_col: str = "status") -> DataFrame:
    """F5. Empty (or containing ``Error``, when ``error_substring``) -> error;
    starting with ``Reject:`` -> rejected; else published.  A ``status`` column
    that is already there (e.g. from generation) and is not ``ok`` wins."""
    p = F.col(col)
    bad = p.isNull() | (p == "")
    if error_substring:
        bad = bad | p.contains(ERROR_WORD)
    gate = (F.when(bad, F.lit(ERROR))
            .when(p.startswith(REJECT_PREFIX), F.lit(REJECTED))
            .otherwise(F.lit(PUBLISHED)))
    if status_col in df.columns:
        gate = F.when(F.col(status_col).isNull() | (F.col(status_col) == "ok"), gate).otherwise(F.col(status_col))
    return df.withColumn(status_col, gate)


def run_summary(df: DataFrame, group: tuple[str, ...] = ("folder",), status_col: str = "status") -> DataFrame:
    """A4. Rows per folder and status (published N of total M, errors, rejects)."""
    return df.groupBy(*group, status_col).agg(F.count(F.lit(1)).alias("n"))


def posts(df: DataFrame, max_length: int = POST_MAX, promotion: str = "promotion", url: str = "url") -> DataFrame:
    """P19 + P17 + F6 + P18. Strip both fields, measure the promotion without links,
    mark ``ready`` or ``too_long`` (failing rows are kept, not dropped), build the post."""
    s = df.withColumn(promotion, strip_ws(promotion)).withColumn(url, strip_ws(url))
    n = link_free_length(promotion).cast("long")
    return (s.withColumn("link_free_len", n)
            .withColumn("status", F.when(F.col("link_free_len") <= max_length, F.lit("ready"))
                        .otherwise(F.lit("too_long")))
            .withColumn("post", post_text(promotion, url)))
