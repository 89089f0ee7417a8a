"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def connected_components(edges: DataFrame, ws: Workspace, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b, longs); component is the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., SoCC 2014). Each step takes minima with map-side
    combining and joins them back, so a node of very high degree is no single task's group: what is sent for it is one row
    per task, and the join's large side can be split. Every round is a written table, so lineage stays short and a
    lost executor costs one round at most. Null ends and loops are ignored; no edges give no rows.
    """
    now = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before, k = ws.save(now, f"{name}0"), None, 0
    while True:
        seen = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
        if seen == before or seen[0] == 0:
            break
        before, k = seen, k + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = ws.save(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}{k}")
        if k > 1:
            ws.drop(f"{name}{k - 2}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
