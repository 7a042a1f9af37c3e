"""Closures: ancestry and reachability by semi-naive joins, cycles by paths."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, functions as F

from ..session import cut


def paths(edges: DataFrame, roots: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group, src, dst) edges and (group, node) roots -> group, root, node, depth, path, cycle.

    Every simple path from a root, and one row with cycle = true where a path comes
    back to one of its nodes; it goes no further. The rows are the paths: for
    reachability and depth use ``closure``.
    """
    g = group or []
    edges = cut(edges.select(*g, "src", "dst"))
    known = F.array_contains("path", F.col("dst").cast("string"))
    out = frontier = cut(roots.select(*g, F.col("node").alias("root"), "node", F.lit(0).cast("long").alias("depth"), F.array(F.col("node").cast("string")).alias("path"), F.lit(False).alias("cycle")))
    for k in count(1):
        on = [*[F.col(f"w.{c}").eqNullSafe(F.col(f"e.{c}")) for c in g], F.col("w.node") == F.col("e.src")]
        step = frontier.where("NOT cycle").alias("w").join(edges.alias("e"), on)
        frontier = cut(step.select(*[F.col(f"w.{c}") for c in g], "w.root", F.col("e.dst").alias("node"), F.lit(k).cast("long").alias("depth"), F.concat("w.path", F.array(F.col("e.dst").cast("string"))).alias("path"), known.alias("cycle")))
        if frontier.isEmpty():
            return out
        out = out.union(frontier)


def closure(edges: DataFrame, roots: DataFrame, group: list[str] | None = None) -> DataFrame:
    """group, root, node, depth: each node a root reaches, with its least depth.

    Rounds of a semi-naive join: each finds the nodes one step further that were not
    seen before, until one finds none. So layers with many ways between them cost
    their edges, not their paths.
    """
    g = group or []
    keys = [*g, "root", "node"]
    edges = cut(edges.select(*g, "src", "dst").distinct())
    seen = frontier = cut(roots.select(*g, F.col("node").alias("root"), "node").distinct().withColumn("depth", F.lit(0).cast("long")))

    def same(a: str, b: str, names: list[str]) -> list:
        return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]

    for k in count(1):
        step = frontier.alias("w").join(edges.alias("e"), [*same("w", "e", g), F.col("w.node") == F.col("e.src")])
        step = step.select(*[F.col(f"w.{c}") for c in g], "w.root", F.col("e.dst").alias("node")).distinct()
        frontier = cut(step.alias("a").join(seen.alias("b"), same("a", "b", keys), "left_anti").withColumn("depth", F.lit(k).cast("long")))
        if frontier.isEmpty():
            return seen
        seen = seen.union(frontier)
        if k % 16 == 0:  # else the plan and its partitions grow with the depth
            seen = cut(seen)


def cycles(edges: DataFrame, roots: DataFrame, group: list[str] | None = None) -> DataFrame:
    """group, root, path (joined by `` > ``) for every way back into its own path."""
    g = group or []
    return paths(edges, roots, g).where("cycle").select(*g, "root", F.array_join("path", " > ").alias("path"))


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Distinct nodes reached from any of the roots, in the same rounds, without telling from which."""
    seen = frontier = cut(roots.select("node").distinct())
    for k in count(1):
        step = frontier.join(edges, frontier.node == edges.src).select(F.col("dst").alias("node")).distinct()
        frontier = cut(step.join(seen, "node", "left_anti"))
        if frontier.isEmpty():
            return seen
        seen = seen.union(frontier)
        if k % 16 == 0:
            seen = cut(seen)
