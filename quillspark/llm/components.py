"""Connected components of an edge table by least labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the least node reachable.

    Each step takes the least label around a node, then the label of that
    label, so the number of steps grows with the logarithm of a path. Labels
    are written after each step; self-loops and repeated edges are harmless;
    without edges the result is empty.
    """
    e = stage(edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).distinct(), "edges")
    labels = stage(e.groupBy("u").agg(F.least("u", F.min("v")).alias("root")).withColumnRenamed("u", "node"), "labels")
    while True:
        around = e.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("near"))
        least = labels.join(around.withColumnRenamed("u", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        above = least.select(F.col("node").alias("root"), F.col("root").alias("top"))
        new = stage(least.join(above, "root").select("node", "old", F.least("root", "top").alias("root")), "labels")
        if new.where("root <> old").isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")
