"""Connected components of a graph of any size, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import durable


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges(a, b) of one orderable type -> (node, root), root the least node of its component.

    Only nodes with an edge to another node appear; null ends, loops and repeated edges are ignored.  Links stay in
    Spark: each round is written to the shared folder, and the rounds end when the set of edges no longer changes.  The edges
    of a hub meet its least neighbour in joins that adaptive execution splits; sums over them are partial first.
    """
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(now)
    for _ in range(rounds):
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = durable(small.distinct())
        before, mark = mark, _mark(now)
        if before == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components not found in {rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)
