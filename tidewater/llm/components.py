"""Connected components by hooking and contraction, with each step as a join or a partial aggregation.

A node hooks to the smallest of its neighbours and itself; chains of hooks are shortened by doubling until every node
points to a root; then edges are carried over to the roots and the round repeats on the few that are left. Each table
is written before the next step, so nothing is repeated and a lost executor costs its tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import staged
from tidewater.operators.skew import hot_join


def _roots(spark, edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges``: the end of its chain of smallest neighbours."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
    hooks = staged(spark, both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("root")), "components-hooks")
    while True:
        beyond = hooks.select(F.col("node").alias("at"), F.col("root").alias("further"))
        stepped = staged(spark, hot_join(hooks, beyond, {"root": "at"}, "left").select("node", F.coalesce("further", "root").alias("root"), (F.coalesce("further", "root") != F.col("root")).alias("moved")), "components-jump")
        hooks = stepped.select("node", "root")
        if stepped.filter("moved").isEmpty():
            return hooks


def components(edges: DataFrame, nodes: DataFrame, node: str, name: str) -> DataFrame:
    """``node, component`` for every row of ``nodes``: the least ``name`` (a long, null last) in its component.

    ``edges`` has columns ``a`` and ``b``; nodes without an edge are components of their own.
    """
    spark = edges.sparkSession
    left = edges.filter("a != b").select("a", "b")
    steps: list[DataFrame] = []
    while not left.isEmpty():
        roots = _roots(spark, left)
        steps.append(roots)
        at = lambda side: roots.select(F.col("node").alias(f"{side}_node"), F.col("root").alias(f"{side}_root"))
        moved = hot_join(hot_join(left, at("a"), {"a": "a_node"}), at("b"), {"b": "b_node"})
        left = staged(spark, moved.filter("a_root != b_root").select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "components-edges")
    placed = nodes.select(F.col(node).alias("_node"), F.col(node).alias("_root"), F.col(name).alias("_name"))
    for roots in steps:
        placed = hot_join(placed, roots, {"_root": "node"}, "left").select("_node", F.coalesce("root", "_root").alias("_root"), "_name")
    placed = staged(spark, placed, "components-placed")
    names = placed.groupBy(F.col("_root").alias("_named")).agg(F.min("_name").alias("component"))
    return hot_join(placed, names, {"_root": "_named"}).select(F.col("_node").alias(node), "component")
