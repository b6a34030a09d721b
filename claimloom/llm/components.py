"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import drop_tables, write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the node's least neighbour (or the node itself).
    Small star: every smaller neighbour of a node, and the node, are linked to its least neighbour."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node of ``edges`` with a neighbour: the least id it reaches.

    Rounds grow with the logarithm of the longest path. No node's neighbours are gathered: minima are taken with
    partial results and joined back, so a node with many neighbours is split like any skewed join key. Each round is
    written to the shared folder.
    """
    now = write_table(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = None
    while True:
        stars = write_table(_star(_star(now, True), False), "stars")
        digest = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if digest == seen:
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                stars.select(F.col("v").alias("id"), F.col("v").alias("component"))
            ).distinct()
        drop_tables(now)
        now, seen = stars, digest
