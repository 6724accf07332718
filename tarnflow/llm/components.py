"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import stage, unstage


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "u").select("u", "v", "m")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for the ends of ``edges(u, v)``: the smallest node that is reachable.

    Every round hooks neighbours to their smallest neighbour with two aggregations (combined
    before the shuffle) and two joins, in which Spark may split a hub; the count of rounds grows
    with the logarithm of the longest path. Each round is written to shared storage, so no
    lineage piles up, and the tables of the round before are deleted. No node, edge or label comes to the driver; only one flag a round does.
    Self edges, repeated edges, nulls (ignored) and an empty table are fine.
    """
    edges = edges.where("u IS NOT NULL AND v IS NOT NULL").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = stage(edges.where("u <> v").distinct(), "edges")
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the joins see plain tables and Spark can split a hub's neighbours.
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        # Large star: every larger neighbour hangs on the smallest neighbour.
        large = _star(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: what hangs on a node hangs on the smallest of these.
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = _star(large, low).select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        new = stage(small.select("e.*").where("u <> v").distinct(), "edges")
        # Done when every node hangs on one node that itself hangs on none.
        roots = new.select(F.col("v").alias("u")).distinct()
        hanging = new.select("u")
        done = roots.join(hanging, "u", "left_semi").isEmpty() and (
            new.groupBy("u").count().where("count > 1").isEmpty()
        )
        unstage(edges, least, low)
        edges = new
        if done:
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return nodes.unionByName(own)
    raise RuntimeError(f"components did not settle within {rounds} rounds")
