"""Connected components of a distributed edge list by alternating stars.

Edges never reach the driver.  A round is two aggregates with a join each; the number of
rounds grows with the logarithm of the longest chain.  A star step makes exactly one edge of each,
so the list never grows, and equal edges are only put together in the end: a step has no exchange for
that, whose tasks the driver would have to keep.  The edges of a hub (a node with more than
``HUB`` edges, so there are at most edges / ``HUB`` of them) don't meet in one task: hubs
and their least neighbours go to where the edges are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curata.llm.common import lighten, stage

#: Edges that make a hub, and hubs that are sent to all executors at most; beyond, Spark joins by shuffle.
HUB, MOST_HUBS = 2048, 4_000_000


def _with_least(near: DataFrame, least: DataFrame, edges: int) -> DataFrame:
    """(u, v, m) of every edge (u, v) with what its u links to; ``least`` is (u, m, n)."""
    hubs = least.where(F.col("n") > HUB).select("u", F.col("m").alias("hub_m"))
    hubs = F.broadcast(hubs) if edges // HUB <= MOST_HUBS else hubs
    both = near.join(hubs, "u", "left")
    plain = both.where("hub_m is null").select("u", "v").join(least.where(F.col("n") <= HUB).select("u", "m"), "u")
    return both.where("hub_m is not null").select("u", "v", F.col("hub_m").alias("m")).union(plain.select("u", "v", "m"))


def _star(edges: DataFrame, small: bool, count: int) -> DataFrame:
    """One star step over undirected edges (u > v): link neighbours to the least one, an edge for each edge."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    if small:  # neighbours below u, with u itself: it takes the place of the least one
        least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        out = _with_least(edges, least, count)
        return out.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    # neighbours above u, to the least of u and all its neighbours
    least = edges.union(back).groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _with_least(back, least, 2 * count).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _mark(edges: DataFrame) -> tuple:
    """The number of edges and a sum over them that tells lists apart."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u, v): root is the least node reachable.

    The edges are read some times over: pass a table that is cheap to read."""
    lighten(edges.sparkSession)
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    seen = _mark(e)
    count = seen[0]
    while count:
        e = stage(_star(e, False, count))
        e = stage(_star(e, True, count))
        mark = _mark(e)
        if mark == seen:
            break
        seen = mark
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).distinct()
