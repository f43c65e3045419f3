"""Connected components by alternating large-star and small-star steps.

Every step is two aggregations with map-side minima and two joins; hubs are never gathered. The
links of each step are written to the shared folder, and only two sums come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import written


def _oriented(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        "a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = links.union(links.select("b", "a"))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are linked to the smallest of them."""
    smallest = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        smallest.select("a", F.col("m").alias("b")))


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``) but the roots themselves.

    ``root`` is the smallest node of the component. Repeated links and links of a node to itself
    are harmless. No links give no rows.
    """
    state, before = written(_oriented(links), purpose), None
    while True:
        sums = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums[0] == 0 or tuple(sums) == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(sums)
        wide = written(_oriented(_large_star(state)), purpose)
        state = written(_oriented(_small_star(wide)), purpose)
