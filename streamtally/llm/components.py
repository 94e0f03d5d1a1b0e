"""Connected components of an edge table: smallest node of each component, by repeated minima and jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.session import stored

from .common import merged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the long columns a and b. Each round is written to the shared folder;
    every edge moves to smaller and smaller roots until each node points at its component's smallest node."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = stored(both, "edges")
    label = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        # The smallest root among the neighbours, then the root of that root.
        seen = merged(both, label.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        nearer = merged(label, seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("root")
        )
        jump = label.select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = merged(nearer, jump, "root", "left").select("node", "was", F.coalesce(F.least("root", "above"), "root").alias("root"))
        moved = stored(moved, "labels")
        if moved.filter("root <> was").isEmpty():
            return moved.select("node", F.col("root").alias("component"))
        label = moved.select("node", "root")
