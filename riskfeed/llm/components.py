"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is a minimum per node (combined map-side) joined back to the edges, so a hub with
any number of neighbours is never gathered in one place. Edges are written to the shared
folder between rounds; the number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeed.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) with a > b. Large star: every node's larger neighbours are tied to the
    smallest node around it; small star: its smaller neighbours and itself are."""
    if large:
        near = edges.union(edges.select("b", "a"))
    else:
        near = edges
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = near.join(least, "a")
    if large:
        tied = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        tied = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
    return tied.where("a > b").distinct()


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (smallest node reachable) for every node that has a link."""
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    edges = stage(edges, "cc-edges")
    mark = _print(edges)
    while mark[0]:
        edges = stage(_star(_star(edges, True), False), "cc-round")
        now = _print(edges)
        if now == mark:
            break
        mark = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select("b", "b")).distinct()
