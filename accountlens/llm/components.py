"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood instead."""
    both = _both_ways(links)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, name: str = "components", max_rounds: int = 100) -> DataFrame:
    """``links`` (u, v: any direction, repeats allowed) to (node, root), root the smallest node that can be reached.

    Nodes without a link to another node are not returned. Each round is written to the shared folder; the number of
    rounds grows with the logarithm of the longest chain. A node with very many neighbours is aggregated map-side and
    joined to one row, so that adaptive execution can split it.
    """
    now = written(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), name)
    before = None
    for _ in range(max_rounds):
        # The same sum of hashes twice: no link has moved.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        now = written(_small_star(_large_star(now)).distinct(), name)
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
