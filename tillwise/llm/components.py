"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import stage


def _hangs(e: DataFrame) -> bool:
    """Whether every node ``u`` of distinct edges hangs under one ``v`` that hangs under none."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not node.agg(F.max((F.col("up") + F.col("down") > 1) & (F.col("up") > 0))).first()[0]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node reachable.

    Each round links neighbours to the smallest one seen (large star), then hangs
    every node under its smallest neighbour (small star); rounds needed grow with the
    logarithm of a component's diameter. A hub's neighbours are never gathered: the
    smallest is an aggregate, joined back. Every round is a written table. Edges that are
    nodes and their roots already, as from an earlier call, need no round.
    """
    e = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct())
    while not _hangs(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stage(
            both.filter("v > u").join(low, "u").filter("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        under = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(under, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(hung.filter("u > v").unionByName(under.select("u", F.col("m").alias("v"))).distinct())
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)
