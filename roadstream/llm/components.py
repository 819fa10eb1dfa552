"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import stored

ROUNDS = 200


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of `edges` (a, b); the nodes are longs.

    Each round the components point to their smallest neighbour, pointers are followed a few steps, and the edges are
    taken between what they point to; edges inside a component vanish. Every step is a pre-combined aggregation or a join of
    tables that Spark can split, so a node with very many edges is no single task.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.where("a <> b").distinct(), "edges")
    label = stored(edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    for _ in range(ROUNDS):
        if edges.isEmpty():
            return label
        up = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")).select(F.col("a").alias("v"), "up")
        up = stored(up, "up")
        for _ in range(2):  # pointers only lead to smaller nodes, so following them ends
            step = up.select(F.col("v").alias("w"), F.col("up").alias("next"))
            up = stored(up.join(step, F.col("up") == F.col("w")).select("v", F.col("next").alias("up")), "up")
        label = stored(
            label.join(up, F.col("component") == F.col("v"), "left")
            .select("node", F.coalesce("up", "component").alias("component")), "labels")
        left = up.select(F.col("v").alias("a"), F.col("up").alias("x"))
        right = up.select(F.col("v").alias("b"), F.col("up").alias("y"))
        edges = stored(
            edges.join(left, "a").join(right, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "edges")
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
