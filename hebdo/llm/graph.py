"""Connected components of a sparse graph, on DataFrames, by hooking and contraction.

Each round every node hooks onto its least neighbour (the aggregate is partial
before its shuffle), the hooks are followed to their roots by doubling, and
the edges are contracted to roots: edges inside a tree disappear, so each
round joins far fewer rows than the last. Joins are plain equi-joins, which
AQE splits where a hub's edges pile up. Every round is staged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import stage


def contracted(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b, staged."""
    return stage(pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                 "cc-edges")


def roots(edges: DataFrame) -> DataFrame:
    """(node, parent): every node of ``edges`` with the root of its tree of hooks; staged."""
    near = edges.groupBy("a").agg(F.min("b").alias("m")).unionByName(
        edges.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("m")))
    hook = stage(near.groupBy("a").agg(F.min("m").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("parent")), "cc-hooks")
    while True:
        up = hook.select(F.col("node").alias("via"), F.col("parent").alias("above"))
        step = stage(hook.join(up, hook["parent"] == up["via"]).select(
            "node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")), "cc-hooks")
        if step.filter("moved").isEmpty():
            return step.select("node", "parent")
        hook = step.select("node", "parent")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge (a, b) to another; component is the least node reachable."""
    left, found = contracted(edges.select("a", "b")), None
    while found is None or not left.isEmpty():
        tree = roots(left)
        if found is None:
            found = tree.select("node", F.col("parent").alias("component"))
        else:
            found = stage(found.join(tree.select(F.col("node").alias("via"), "parent"), F.col("component") == F.col("via"), "left")
                          .select("node", F.coalesce("parent", "component").alias("component")), "cc-found")
        one = tree.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        two = tree.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        left = contracted(left.join(one, "a").join(two, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    return found
