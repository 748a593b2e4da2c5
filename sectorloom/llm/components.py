"""Connected components of an edge table by alternating large-star and small-star steps.

Each step lets every node point its neighbours to the smallest node it knows, so chains shorten by half and
a component ends as a star around its smallest node. A step is a minimum per node, combined on the map side,
and a join back; a node with very many neighbours is a skewed join that Spark splits, never one group in a task.
The edges are written between rounds, and only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Edges with a null end and loops join nothing; nodes that have only such edges are left out. Repeated
    edges count once. No edges, no rows.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    current = edges.where("a <> b").select(high, low).distinct()
    current, at = written(current, "edges")
    seen = _digest(current)
    while seen[0]:
        current, following = written(_small_star(_large_star(current)), "edges")
        discard(edges.sparkSession, at)
        at, now = following, _digest(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple[int, int]:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    n, total = edges.agg(F.count("*"), F.sum(hashed)).first()
    return n, int(total or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node point to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("__least"))
    linked = both.join(least, "u").where("v > u")
    return linked.select(F.col("v").alias("u"), F.least("u", "__least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("__least"))
    moved = edges.join(least, "u").where("v <> __least")
    return (
        moved.select(F.col("v").alias("u"), F.col("__least").alias("v"))
        .unionByName(least.select("u", F.col("__least").alias("v")))
        .distinct()
    )
