"""Tumbling and sliding windows over panes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import json_at
from ..functions.times import floor_to_slide, parse_ms
from ..plans.rules import DEFAULT_TIME_FIELD, Windowing
from .aggregates import DISTINCT_CAP, Compiled


def event_time(w: Windowing) -> Column:
    """A rule's time of an event: ingestion if it says so, else its top-level field; what isn't positive falls back to event time, then ingestion."""
    if w.use_kafka_timestamp:
        return F.col("ingest_ms")
    own = F.col("event_ms") if w.timestamp_field == DEFAULT_TIME_FIELD else parse_ms(json_at("raw", [w.timestamp_field]), w.timestamp_format)
    return F.coalesce(F.when(own > 0, own), F.when(F.col("event_ms") > 0, F.col("event_ms")), F.col("ingest_ms"))


def pane_of(w: Windowing) -> Column:
    return floor_to_slide(event_time(w), w.slide, w.offset)


def to_windows(panes: DataFrame, size: Column, slide: Column, pane: str = "pane") -> DataFrame:
    """Each pane with every window that holds it. Windows end on the slide grid and are size long; a pane counts if it starts in one.

    So a size that the slide doesn't divide makes windows of whole panes only, and a slide above the size makes none.
    """
    k = F.floor(size / slide).cast("int")
    out = panes.withColumn("_k", F.explode(F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>"))))
    out = out.withColumn("window_end_ms", F.col(pane) + F.col("_k") * slide)
    return out.withColumn("window_start_ms", F.col("window_end_ms") - size).drop("_k")


def aggregate(routed: DataFrame, aggs: list[Compiled], keys: list[str], size: Column, slide: Column, tumbling: bool) -> DataFrame:
    """keys, window_start_ms, window_end_ms, _raw and a double per aggregate, from (keys, pane, value columns), in one pass over ``routed``.

    ``size`` and ``slide`` are literals or among the keys, so that rules of any windows go together. A tumbling window is its pane: one
    aggregation. Others aggregate panes first and merge those, so an event is one row in one shuffle however many windows hold it. Exact distinct
    counts merge distinct values: a pane is one row with the other partials, and one for each of its values. Ordered sums need ``offset`` and ``_run`` in
    ``routed``; a pane is then a row for each run, in tumbling windows, too.
    """
    run = ["_run"] if any(a.ordered for a in aggs) else []
    if tumbling and not run:
        out = routed.groupBy(*keys, "pane").agg(*[a.direct() for a in aggs], F.count(F.lit(1)).alias("_raw"))
        return out.withColumns({"window_start_ms": F.col("pane"), "window_end_ms": F.col("pane") + size}).drop("pane")
    at, merging, exact = [*keys, "window_start_ms", "window_end_ms"], [a for a in aggs if not a.exact], [a for a in aggs if a.exact]
    partials = [c.alias(name) for name, c in {n: c for a in merging for n, c in a.partials().items()}.items()]
    if not exact:
        panes = routed.groupBy(*keys, "pane", *run).agg(F.count(F.lit(1)).alias("_n"), *partials)
        return to_windows(panes, size, slide).groupBy(*at).agg(F.sum("_n").alias("_raw"), *[a.merged() for a in merging])
    tagged = [F.struct(F.lit(0).alias("tag"), F.lit(None).cast("string").alias("value"))]
    tagged += [F.when(F.col(a.v).isNotNull(), F.struct(F.lit(k).alias("tag"), F.col(a.v).alias("value"))) for k, a in enumerate(exact, 1)]
    whole = F.col("_x.tag") == 0
    values = [F.when(whole, F.col(c)).alias(c) for c in dict.fromkeys([*[a.v for a in merging if a.v in routed.columns], *run])] + [F.col("offset")] * len(run)
    rows = routed.withColumn("_x", F.explode(F.filter(F.array(*tagged), lambda x: x.isNotNull()))).select(*keys, "pane", F.col("_x.tag").alias("_tag"), F.col("_x.value").alias("_value"), *values)
    panes = rows.groupBy(*keys, "pane", "_tag", "_value", *run).agg(F.count(F.lit(1)).alias("_n"), *partials)
    if tumbling:  # a value of a window is one row already
        kept = [F.when(F.col("_tag") == 0, F.col(name)).alias(name) for name in ("_n", *dict.fromkeys(n for a in merging for n in a.partials()))]
        windows = to_windows(panes.select(*keys, "pane", "_tag", *kept), size, slide)
        counts = [a.limited(F.count(F.when(F.col("_tag") == k, 1))).cast("double").alias(a.spec.alias) for k, a in enumerate(exact, 1)]
        return windows.groupBy(*at).agg(F.sum("_n").alias("_raw"), *counts, *[a.merged() for a in merging])
    windows = to_windows(panes, size, slide).groupBy(*at, "_tag", "_value").agg(F.sum("_n").alias("_raw"), (F.size(F.collect_set("pane")) if run else F.count(F.lit(1))).alias("_panes"), *[a.merged() for a in merging])
    most = F.max(F.when(F.col("_tag") == 0, F.col("_panes"))) * DISTINCT_CAP
    counts = [a.limited(F.count(F.when(F.col("_tag") == k, 1)), most).cast("double").alias(a.spec.alias) for k, a in enumerate(exact, 1)]
    rest = [F.max(F.when(F.col("_tag") == 0, F.col(f"`{a.spec.alias}`"))).alias(a.spec.alias) for a in merging]
    return windows.groupBy(*at).agg(F.max(F.when(F.col("_tag") == 0, F.col("_raw"))).alias("_raw"), *counts, *rest)
