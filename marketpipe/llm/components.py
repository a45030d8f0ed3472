"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, written


def large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest of its neighbours and itself.

    The smallest neighbours are written first, so that the join has plain shuffles on both sides and a hub's edges are split over tasks.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lows = written(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), "large-star")
    out = written(both.filter("b > a").join(lows, "a").select(F.col("low").alias("a"), "b").filter("a <> b").distinct(), "edges")
    dropped(lows)
    return out


def small_star(edges: DataFrame) -> DataFrame:
    """Links each node's smaller neighbours, and itself, to the smallest of them, written first as above. Edges have a < b."""
    lows = written(edges.groupBy("b").agg(F.min("a").alias("low")), "small-star")
    near = edges.join(lows, "b").select(F.col("low").alias("a"), F.col("a").alias("b")).filter("a <> b")
    out = written(near.unionByName(lows.select(F.col("low").alias("a"), "b")).distinct(), "edges")
    dropped(lows)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every node of the edges (a, b): the smallest id it reaches. Both steps repeat until no edge changes."""
    ends = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    now, state = written(ends, "edges"), None
    while True:
        larger = large_star(now)
        dropped(now)
        now = small_star(larger)
        dropped(larger)
        n, total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, total) == state:
            break
        state = n, total
    return now.select(F.col("b").alias("id"), F.col("a").alias("label")).unionByName(now.select(F.col("a").alias("id"), F.col("a").alias("label")).distinct())
