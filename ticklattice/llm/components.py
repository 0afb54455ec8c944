"""Connected components of an edge table by contraction: hook to the smallest neighbour, jump to the root, relabel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table


def _roots(hooks: DataFrame) -> DataFrame:
    """(node, root) of a forest given as (node, root) with root < node, by pointer doubling."""
    while True:
        ahead = hooks.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = write_table(hooks.join(ahead, "root", "left").select("node", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("on")), "hooks")
        hooks = moved.select("node", "root")
        if moved.filter("on").isEmpty():
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes on an edge (a, b); component is the smallest node reachable.

    In each round every node that has a smaller neighbour hooks to the smallest, an aggregate that is combined before its
    shuffle; edges are then renamed to the roots, and those inside a tree go. It ends when no edge is left: each round joins at
    least two roots of every component that has several. The joins are of written tables, so Spark splits a hub's rows.
    """
    ends = lambda a, b: (F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = write_table(edges.filter("a <> b").select(*ends("a", "b")).distinct(), "edges")
    trees = None
    while not edges.isEmpty():
        hooks = _roots(write_table(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "hooks"))
        left, right = hooks.select(F.col("node").alias("a"), F.col("root").alias("x")), hooks.select(F.col("node").alias("b"), F.col("root").alias("y"))
        renamed = edges.join(left, "a", "left").join(right, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
        edges = write_table(renamed.filter("a <> b").select(*ends("a", "b")).distinct(), "edges")
        if trees is not None:
            later = hooks.select(F.col("node").alias("root"), F.col("root").alias("far"))
            hooks = write_table(trees.join(later, "root", "left").select("node", F.coalesce("far", "root").alias("root")).unionByName(hooks), "trees")
        trees = hooks
    if trees is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return trees.select("node", F.col("root").alias("component")).unionByName(trees.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct())
