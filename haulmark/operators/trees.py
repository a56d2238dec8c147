"""Walks over self-referencing keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.sources.writes import stage


def walk_down(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """Every node reachable from a root (a node without parent): root, depth and path of keys.

    Each node points at an ancestor and knows the path from there; a round replaces the pointer by that ancestor's
    own, so the number of rounds follows the logarithm of the depth, and there is no limit on it. Rounds are stored,
    which cuts the lineage; the driver sees one number per round. Nodes without a root above them, in a circle or
    below a key that is no node, stay open after the pointers have passed every chain, and are not returned.
    """
    up = stage(nodes.select(F.col(node).cast("long").alias("node"), F.col(parent).cast("long").alias("parent"))
               .select("node", "parent", F.coalesce("parent", "node").alias("above"),
                       F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth"),
                       F.when(F.col("parent").isNull(), F.array()).otherwise(F.array("node"))
                       .cast("array<bigint>").alias("steps"),
                       F.col("parent").isNull().alias("rooted")), "tree")
    waiting = up.filter("NOT rooted").count()
    while waiting:
        higher = up.select(F.col("node").alias("above"), F.col("above").alias("next"), F.col("depth").alias("more"),
                           F.col("steps").alias("before"), F.col("rooted").alias("ends"))
        # Only what is not rooted yet has to look up; a circle's members would otherwise grow without end.
        moved = up.filter("NOT rooted").join(higher, "above").select(
            "node", "parent", F.col("next").alias("above"), (F.col("depth") + F.col("more")).alias("depth"),
            F.concat("before", "steps").alias("steps"), F.col("ends").alias("rooted"))
        up = stage(up.filter("rooted").unionAll(_without_circles(moved)), "tree")
        waiting = up.filter("NOT rooted").count()
    return up.select("node", F.col("above").alias("root"), "parent", "depth",
                     F.array_join(F.concat(F.array("above"), "steps").cast("array<string>"), "/").alias("path"))


def _without_circles(moved: DataFrame) -> DataFrame:
    """A node whose path meets one key twice hangs in or under a circle and has no root."""
    return moved.filter(F.col("rooted") | (
        (F.size(F.array_distinct("steps")) == F.size("steps")) & ~F.array_contains("steps", F.col("above"))))
