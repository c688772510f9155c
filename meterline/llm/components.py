"""Connected components of a graph of keys, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _least(pairs: DataFrame) -> DataFrame:
    """(a, b) with the least neighbour m of each a. The minimum is taken before the rows meet it, so a key with very
    many neighbours costs a partial aggregate and a join that Spark can split."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    return pairs.join(least, "a")


def components(edges: DataFrame) -> DataFrame:
    """(key, component) for each key in edges (a, b); component is the least key that links reach.

    Stars are grown in turns: each key's larger neighbours are linked to its least one, then each key's smaller ones
    are. Rounds stop when nothing changes. Loops and repeated edges are allowed, and an edge with a null end is none; a key
    that only loops name has no row; a table without edges gives none. Of equally near keys the least counts, so the result
    doesn't depend on the order of rows."""
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _least(both).where("b > a").select(F.col("b").alias("a"), F.least("m", F.col("a")).alias("b"))
        small = _least(large.distinct())
        now = cut(small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("component")).union(now.select(F.col("b").alias("key"), F.col("b").alias("component")).distinct().join(now.select(F.col("a").alias("key")).distinct(), "key", "left_anti"))
