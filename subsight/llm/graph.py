"""Connected components over edges of long node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.llm.tables import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = stored(e.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = e.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``: root is the least node reachable.

    Alternating large-star and small-star rounds, each a map-side combined
    minimum and an equi-join, until the edge set stands still. The minima are
    written first: both sides of the join are then plain shuffles, so where
    the minima are not broadcast adaptive execution splits the edges of a hub
    over several tasks. The edge set never grows, each
    round is a written table, and only an edge count and a checksum reach
    the driver. Self-loops and repeated edges are allowed, nulls are dropped.
    """
    e = edges.where("u is not null and v is not null and u != v") \
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = stored(e, "edges")
    mark = _mark(e)
    while mark[0]:
        e = stored(_small_star(_large_star(e)), "stars")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
