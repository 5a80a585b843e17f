"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge table (a, b), with the smallest node of its component as root.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends, and draws the edges
    between those ends; rounds stop when no edge is left. Hooks of a hot node combine before the shuffle, and
    the joins leave skew to adaptive execution. Nothing but counts comes to the driver.
    """
    rest = cut_lineage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("a").alias("b"), F.col("b").alias("a")))
        hooks = cut_lineage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "hooks")
        while True:
            ends = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            further = hooks.join(ends, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
            further = cut_lineage(further, "hooks")
            hooks = further.select("node", "root")
            if further.where("moved").isEmpty():
                break
        if labels is None:
            labels = hooks
        else:
            later = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = labels.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            labels = cut_lineage(labels, "labels")
        left = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = rest.join(left, "a").join(right, "b").where("ra <> rb")
        rest = cut_lineage(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if labels is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
