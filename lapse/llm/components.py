"""Connected components of a graph given as edges, by alternating stars.

Each round replaces every edge by edges to the smallest neighbour, first for
larger and then for smaller neighbours; rounds needed grow with the logarithm
of the size. Edges stay distributed; a round ends in a landed table, so the
lineage stays short and the previous round's table is deleted. Minima are
pre-aggregated before the shuffle, and hot nodes are joined with AQE's skew
splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.operators.materialize import land, release

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = edges.join(low, "a").where("b != low")
    return low.select("a", F.col("low").alias("b")).union(joined.select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) other than the roots
    themselves; a root is the smallest node of its component."""
    edges = land(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-edges")
    state = _signature(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        before, edges = edges, land(_small_star(_large_star(edges)), "component-edges")
        release(before)
        last, state = state, _signature(edges)
        if state == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
