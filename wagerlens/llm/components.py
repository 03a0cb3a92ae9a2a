"""Connected components of an edge list, smallest member first, in DataFrame steps.

Alternating large-star and small-star contraction: every step is an aggregation and a
join on a node, so no neighbourhood is gathered anywhere, and the number of rounds is
logarithmic. Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm._io import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour (large: the greater ones, else the smaller ones and the
    node itself) to the least of the neighbourhood. Edges are (a, b) with a > b."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        out = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        out = edges.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return out.filter("a > b").distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b) but the components' least members."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    now, seen = stage(pairs, "cc"), None
    for _ in range(rounds):
        now = stage(_star(_star(now, True), False), "cc")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
