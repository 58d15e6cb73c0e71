"""Connected components of a link table by alternating stars.

Large-star hangs every larger neighbour of a node on the smallest node around
it, small-star every smaller one; both keep the components. Alternating them
ends with each node linked to the smallest node of its component. Minima are
pre-aggregated before the shuffle and read back by a join, so a hub with any
number of links is never gathered in one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import Workspace


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger node a to the smaller node b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``links`` (a, b), longs, in any direction. Returns (node, root) for
    every node that has a link to another one; root is the smallest node of
    the component, which itself has no row."""
    edges = work.put(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges0")
    state, k = _state(edges), 0
    while state[0]:
        k += 1
        edges = work.put(small_star(large_star(edges)), f"edges{k}")
        before, state = state, _state(edges)
        work.drop(f"edges{k - 1}")
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
