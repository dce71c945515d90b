"""Connected components by alternating star contraction.

Each round is two aggregations and joins over the links (at most one row per
link and round); the rounds grow with the logarithm of a component's size.
Nothing is collected: the driver sees one number per round, whether the links
changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of u moves to u's smallest neighbour.
    Small star: every smaller neighbour of u, and u, moves to the smallest."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:
        moved = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v): root is the smallest
    node (as a signed number) of its component. Raises if ``max_rounds`` rounds
    do not settle the links rather than return a partial answer."""
    ordered = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = shared_table(ordered.distinct())
    mark = None
    for _ in range(max_rounds):
        now = shared_table(_star(_star(now, True), False))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or tuple(seen) == mark:
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = tuple(seen)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
