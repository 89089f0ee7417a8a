"""Deduplication with a horizon that every repeat extends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedup_ttl(events: DataFrame, key: Column, ttl_ms: int, time: str = "ingest_ms", tie: str = "offset") -> DataFrame:
    """Events that come ``ttl_ms`` or more after the one before with their key, or first; null and empty keys go.

    Since repeats extend the horizon, only the gap to the event just before matters, whether or not that one was kept.
    """
    order = W.partitionBy("_key").orderBy(time, tie)
    rows = events.withColumn("_key", key).where("_key is not null and _key <> ''")
    gap = F.col(time) - F.lag(time).over(order)
    return rows.withColumn("_gap", gap).where(F.col("_gap").isNull() | (F.col("_gap") >= ttl_ms)).drop("_gap", "_key")
