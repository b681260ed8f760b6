"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.session import cut_lineage, drop_steps


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours below the least node next to them: the larger ones of each node, or the smaller ones and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # Edges point from the greater node a to the smaller b, so a's neighbours in `edges` are the smaller ones.
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs, in any direction; gives ``(node, component)`` for every node that has an edge
    to another one, ``component`` being the least node it is connected with.

    Each round is two grouped minima and two joins over the edge table (a node with very many edges is reduced
    map-side, and adaptive execution splits its join); a round is written to the shared folder before the next.
    Rounds end when a round changes nothing, which takes about the logarithm of the longest path. Rows with a
    null and loops are left out.
    """
    current = cut_lineage(edges.where(F.col("a") != F.col("b"))
                          .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _digest(current)
    while True:
        after = cut_lineage(_star(_star(current, large=True), large=False))
        digest = _digest(after)
        drop_steps(current)
        current = after
        if digest == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = digest


def _digest(edges: DataFrame) -> tuple:
    # Sums as decimals, so that they cannot overflow; equal counts and sums of two hashes mean equal sets of edges.
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))).first())
