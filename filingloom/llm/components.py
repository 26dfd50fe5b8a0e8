"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Returns node and root, the smallest node that it reaches, for each node of an edge.

    Each step joins every node's neighbours to the smallest of them; the number of steps grows as the logarithm of the
    largest component, and the table never grows. The smallest neighbours are written before they are joined, so that a
    node with very many edges can be split over tasks. Self-loops and repeated edges do no harm; nulls are not nodes; no
    edges give no rows.
    """
    e = C.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    stamp = _stamp(e)
    while stamp[0]:
        both = e.union(e.select("b", "a"))
        low = C.cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(C.merged(low), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = C.cut(large.groupBy("a").agg(F.min("b").alias("m")))
        pairs = large.join(C.merged(low), "a")
        small = pairs.select(F.col("b").alias("a"), F.col("m").alias("b")).union(pairs.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        e = C.cut(small)
        now = _stamp(e)
        if now == stamp:
            break
        stamp = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stamp(edges: DataFrame) -> tuple:
    """How many edges there are, and a sum of their hashes: a step that changes neither has settled."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
