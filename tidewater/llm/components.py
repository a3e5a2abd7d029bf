"""Connected components of an edge table, with the edges kept distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _least_neighbour(edges: DataFrame, direction) -> DataFrame:
    """Star step: each node's neighbours move to the smallest of them."""
    sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = sides.join(least, "u").where(direction(F.col("u"), F.col("v")))
    return moved.select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b")).where("a < b")


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it reaches) for every node with an edge.

    ``edges`` has bigint columns a and b.  Large-star and small-star rounds
    run until the edges no longer change; each round's edges are written below
    the shared folder, and the driver sees a count and a checksum alone.
    """
    current = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    mark = None
    while True:
        large = _least_neighbour(current, lambda u, v: v > u)
        up = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        small = (up.join(least, "u").select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b"))
                 .union(least.select(F.col("m"), F.col("u"))).where("a < b"))
        following = materialise(small.distinct(), "edges")
        seen = following.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(current)
        current = following
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    stars = current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(current.select(F.col("a"), F.col("a"))).distinct()
