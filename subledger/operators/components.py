"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.session import materialized


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Rows (node, component): the smallest node that can be reached, for every node of an edge.

    Each node points to a smaller or equal one. In a round it, and what it points to, take the smallest pointer seen across
    an edge, and pointers are followed one step; the rounds grow with the logarithm of the longest path. A node with very
    many edges sends one minimum per task, and its edges are the side of the join that adaptive execution can split. Edges
    with a null end are left out; an empty table has no nodes.
    """
    ends = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).dropna()
    both = materialized(ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    first = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near"))
    pointers = materialized(first.select("node", F.least("node", "near").alias("to")))
    while True:
        # What lies behind a pointer, and the smallest of that across a node's edges.
        behind = pointers.join(pointers.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", "to", "next")
        behind = materialized(behind)
        seen = both.join(behind.select(F.col("node").alias("v"), "next"), "v").groupBy("u").agg(F.min("next").alias("least"))
        found = materialized(behind.join(seen, behind["node"] == seen["u"]).select("node", "to", "next", "least"))
        moved = (
            found.select("node", F.least("next", "least").alias("to"))
            .unionByName(found.select(F.col("to").alias("node"), F.col("least").alias("to")))
            .groupBy("node").agg(F.min("to").alias("to"))
        )
        after = materialized(moved)
        # Pointers only move to smaller nodes; when none did, all nodes of an edge point to the same.
        if after.join(pointers, "node").filter(after["to"] != pointers["to"]).isEmpty():
            return after.select("node", F.col("to").alias("component"))
        pointers = after
