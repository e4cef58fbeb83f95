"""Connected components of an edge table by alternating stars, without collecting edges anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillframe.functions.sizing import store


def _measure(edges: DataFrame) -> tuple:
    """What two equal edge tables have in common, and with near certainty no others."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (longs): the smallest node that it is linked with.

    Large and small stars in turn: each node hangs its larger neighbours, then its smaller ones and itself, on the smallest.
    The rounds grow with the logarithm of the longest chain. Minima are stored before they are joined back, so
    that adaptive execution can split the join at a node with very many neighbours.
    """
    now = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _measure(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("least")))
        large = both.join(least, F.col("a") == F.col("node")).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = store(large.where("a <> b").distinct())
        least = store(large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")))
        hung = large.join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        now = store(hung.union(least.select("node", "least")).where("a <> b").distinct())
        found = _measure(now)
        if found == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = found
