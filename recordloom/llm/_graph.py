"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._store import Stash, cut


def components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs of longs -> (node, component): the smallest node reachable, for every node that has an edge to another.

    Each round is an aggregation and an equi-join, so a node with very many
    neighbours is pre-aggregated and its join rows can be split; a component is
    never gathered in one task. Null ends and loops are ignored.
    """
    with Stash(edges.sparkSession) as stash:
        ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a IS NOT NULL AND b IS NOT NULL AND a != b")
        e, mark, k = stash.save(ends.distinct(), "0"), None, 0
        while True:
            both = e.union(e.select("v", "u"))
            low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).where("u != v").distinct()
            e, k = stash.save(small, str(k + 1)), k + 1
            stash.drop(str(k - 1))
            now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("double"))).first()
            if now == mark:
                break
            mark = now
        roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        return cut(e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots))
