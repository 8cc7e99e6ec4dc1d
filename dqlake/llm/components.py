"""Connected components by alternating large-star and small-star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang every node's neighbours on the smallest of them. A hot centre is only
    aggregated to a minimum and joined back, so its neighbours need not meet in a task."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        return (both.join(low, "u").where("v > u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(low, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b, both long): the component is its
    smallest node. Nodes that are the smallest of theirs are absent. Self-loops are ignored."""
    now = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), "edges")
    mark = None
    while True:
        now = keep(_star(_star(now, True), False), "edges")
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = seen
