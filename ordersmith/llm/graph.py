"""Connected components by repeated joins over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _followed(parents: DataFrame, name: str) -> DataFrame:
    """``node, root`` with each parent followed to the end, twice as far each round."""
    tree = written(parents, name)
    while True:
        up = tree.select(F.col("node").alias("root"), F.col("root").alias("above"))
        # many nodes may hang below one root: both sides are tables, so the join can split them
        step = written(tree.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), name)
        tree = step.select("node", "root")
        if step.where("moved").isEmpty():
            return tree


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for each node of ``edges`` (``a, b`` long), root the smallest of its component.

    Each round hangs every node that has a smaller neighbour below the smallest
    of them, follows these parents to their roots, and keeps only the edges
    between different roots; a node that has a parent is gone from them.  At
    most half of the nodes are left after a round.  Nothing is collected but
    whether rows are left.
    """
    left = written(edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).where("x <> y").distinct(), f"{name}-edges")
    tree: DataFrame | None = None
    while not left.isEmpty():
        hung = _followed(left.groupBy("x").agg(F.min("y").alias("root")).select(F.col("x").alias("node"), "root"), f"{name}-round")
        tree = hung if tree is None else tree.unionByName(hung)
        rx, ry = (hung.select(F.col("node").alias(k), F.col("root").alias(f"r{k}")) for k in ("x", "y"))
        ends = left.join(rx, "x").join(ry, "y", "left").select(F.col("rx").alias("a"), F.coalesce("ry", "y").alias("b"))
        left = written(ends.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), f"{name}-edges")
    if tree is None:
        return left.select(F.col("x").alias("node"), F.col("y").alias("root"))
    tree = _followed(tree, f"{name}-tree")
    return tree.unionByName(tree.select("root").distinct().select(F.col("root").alias("node"), "root"))
