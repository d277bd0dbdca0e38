"""Connected components inside cells by contraction, with joins only.

A round hooks every UMI to its smallest neighbour if that is smaller, replaces parents by their parents until they are roots, and keeps only
the edges between different roots. A root that nobody hooked to has a smaller neighbour in the next round, so every two rounds halve the number of
roots; parents are found in as many steps as the logarithm of the longest chain of hooks. No table grows with the number of rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellamp.session import store


def components(edges: DataFrame) -> DataFrame:
    """(bc, umi, comp) for the UMIs of edges (bc, src, dst), comp being the smallest UMI that can be reached either way."""
    ends = edges.filter("src <> dst").select("bc", F.col("src").alias("umi"), F.col("dst").alias("near"))
    live = store(ends.unionByName(ends.select("bc", F.col("near").alias("umi"), F.col("umi").alias("near"))).distinct())
    found = None
    while True:
        hooked = live.groupBy("bc", "umi").agg(F.min("near").alias("near"))
        roots = to_roots(store(hooked.select("bc", "umi", F.least("umi", "near").alias("root"))))
        if found is None:
            found = roots.select("bc", "umi", F.col("root").alias("comp"))
        else:
            up = roots.select("bc", F.col("umi").alias("comp"), "root")
            found = store(found.join(up, ["bc", "comp"], "left").select("bc", "umi", F.coalesce("root", "comp").alias("comp")))
        other = roots.select("bc", F.col("umi").alias("near"), F.col("root").alias("far"))
        between = live.join(roots, ["bc", "umi"]).join(other, ["bc", "near"]).filter("root <> far")
        live = store(between.select("bc", F.col("root").alias("umi"), F.col("far").alias("near")).distinct())
        if live.isEmpty():
            return found


def to_roots(parents: DataFrame) -> DataFrame:
    """A stored table (bc, umi, root) whose parents are replaced by their parents until none changes."""
    while True:
        up = parents.select("bc", F.col("umi").alias("root"), F.col("root").alias("above"))
        jumped = store(parents.join(up, ["bc", "root"]).select("bc", "umi", F.col("above").alias("root"), (F.col("above") < F.col("root")).alias("moved")))
        parents = jumped.select("bc", "umi", "root")
        if jumped.filter("moved").isEmpty():
            return parents
