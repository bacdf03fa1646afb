"""Connected components of a graph given as an edge table, by stars that grow and shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import shared


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node it reaches.

    Alternates large stars (every node sends its larger neighbours to the smallest one it knows) with small stars
    (the same for its smaller neighbours) until the edges stay the same: O(log n) rounds or few more, each an
    aggregation with map-side combine and an equi-join that can be split, so a node with very many neighbours is no
    single task's work. Only a count and a checksum reach the driver."""
    edges = shared(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct())
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = (
            both.where("b > a").join(least, "a").selectExpr("b AS a", "low AS b").distinct()
        )
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(down, "a").where("b <> low").selectExpr("b AS a", "low AS b")
            .unionByName(down.selectExpr("a", "low AS b")).distinct()
        )
        edges = shared(small)
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        state = (state["n"], state["sum"])
        if state == before:
            break
        before = state
    roots = edges.selectExpr("a AS node", "b AS root")
    return roots.unionByName(edges.selectExpr("b AS node", "b AS root").distinct())
