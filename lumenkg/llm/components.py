"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenkg.llm.workspace import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    linked = both.filter("b > a").join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a")
    moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(linked.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is its smallest node.

    Each round's edges are written to the scratch folder. Rounds grow with the
    logarithm of a component's size; not converging in ``max_rounds`` raises.
    """
    current = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = _digest(current)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        current = materialise(_small_star(_large_star(current)), "edges")
        now = _digest(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("a"), "b").distinct()
    return current.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("component")).distinct()
