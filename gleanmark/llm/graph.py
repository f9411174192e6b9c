"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanmark.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node.

    Each pass lets every node join the neighbour (or itself) that comes first in an
    order hashed anew, and keeps the edges between the nodes joined.  A constant
    share of the nodes goes in each pass, for chains as for stars.  Every step is a
    grouped minimum or an equi-join, and its result a written table.
    """
    left = edges.where("a <> b").select("a", "b").distinct()
    roots: DataFrame | None = None
    turn = 0
    while True:
        left = stage(left, "edges")
        if left.isEmpty():
            break
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)), F.col(c).alias("node"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        joined = stage(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min(order("b")).alias("best"))
            .select("node", F.least(order("node"), "best").getField("node").alias("joins")),
            "joins",
        )
        into = lambda c: joined.select(F.col("node").alias(c), F.col("joins").alias(f"to_{c}"))
        left = (
            left.join(into("a"), "a").join(into("b"), "b").where("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        )
        if roots is None:
            roots = joined.select("node", F.col("joins").alias("root"))
        else:
            moved = joined.select(F.col("node").alias("root"), "joins")
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("joins", "root").alias("root"))
        roots = stage(roots, "roots")
        turn += 1
    if roots is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    first = roots.groupBy("root").agg(F.min("node").alias("component"))
    return stage(roots.join(first, "root").select("node", "component"), "components")
