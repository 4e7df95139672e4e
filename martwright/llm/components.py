"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.tables import Workspace


def components(work: Workspace, links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; root is the least node of a component.

    Large star: each neighbour above a node is linked to the least node around it; small star: so
    are those below. Both keep the components and end in stars. Per node only a minimum is grouped,
    combined before the shuffle, and the join back on the node can be split, so a node with a third
    of all links is no bottleneck. The number of links never grows.
    """
    edges = work.store(_apart(links.select("a", "b")))
    state = _state(edges)
    for _ in range(rounds):
        large = _large_star(edges)
        small = work.store(_small_star(large))
        work.drop(edges)
        edges, before, state = small, state, _state(small)
        if state == before:
            break
    else:
        raise RuntimeError(f"components weren't settled after {rounds} rounds")
    linked = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    found = work.store(linked.unionByName(roots).distinct())
    work.drop(edges)
    return found


def _apart(links: DataFrame) -> DataFrame:
    """Each link once, the larger node first."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    above = both.filter("b > a").join(least, F.col("a") == F.col("n"))
    return above.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    below = edges.join(least, F.col("a") == F.col("n"))
    moved = below.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
