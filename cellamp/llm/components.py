"""Connected components of a stored edge table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellamp.session import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge, root being the smallest node of its component.

    ``edges`` has the columns ``node`` and ``root``. First every node keeps only its smallest smaller neighbour and hands its other
    neighbours over to it, until each node has one parent; then parents are replaced by their parents until none
    changes. Both sides of every join are stored tables, so that a hub that holds most edges is split by adaptive execution.
    """
    smaller, larger = F.least("node", "root"), F.greatest("node", "root")
    level = store(edges.filter("node <> root").select(larger.alias("node"), smaller.alias("root")).distinct())
    while True:
        parents = store(level.groupBy("node").agg(F.min("root").alias("parent")))
        moved = level.join(parents, "node").filter("root <> parent").select(F.col("root").alias("node"), "parent")
        moved = store(moved.distinct())
        if moved.isEmpty():
            break
        level = store(parents.union(moved).distinct().withColumnRenamed("parent", "root"))
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = parents.join(up, "parent", "left").select(
            "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
        )
        jumped = store(jumped)
        parents = jumped.select("node", "parent")
        if jumped.filter("moved").isEmpty():
            break
    tops = parents.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    return parents.withColumnRenamed("parent", "root").union(tops)
