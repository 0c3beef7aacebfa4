"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregates and two joins over the edges; no node's
neighbours are ever gathered in one row. The edge list is written after every
round, and two numbers (count and hash sum) tell when it has settled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.scratch import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u now hangs on the least of u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours hang on the least of them (edges: v < u)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """``u, v`` links between comparable ids -> ``node, root`` (least node of
    the component) for every node that has a link to another one.

    Repeated links and links of a node to itself change nothing; null ends are
    ignored; no links give no rows."""
    edges = cut(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = cut(_small_star(_large_star(edges)), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
