"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionAll(edges.selectExpr("b AS a", "a AS b"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return (
        both.where("b > a").join(least, "a").selectExpr("b AS a", "least AS b").distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest; needs ``a > b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return (
        edges.join(least, "a")
        .selectExpr("explode(array(a, b)) AS a", "least AS b")
        .where("a > b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every linked node but the roots; root: smallest node.

    ``edges`` has columns a > b.  Alternates both star steps until nothing moves; each
    round is a written table.  Smallest neighbours are aggregated before the join and
    the join's hot nodes can be split, so a node with very many links is no bottleneck.
    """
    edges, mark = stored(edges.distinct(), "links"), None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if tuple(state) == mark or not state["n"]:
            return edges.selectExpr("a AS node", "b AS root")
        mark = tuple(state)
        edges = stored(small_star(large_star(edges)), "links")
