"""Rules over historical events, as one DataFrame plan each."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fields import entity, group_key
from ..functions.having import compile_having, names_in, over_aliases, over_events
from ..functions.times import ist_string
from ..operators.aggregates import Compiled, compile_all, run_of_offsets
from ..operators.filters import compile_filter, topic_matches
from ..operators.routing import matching
from ..operators.windows import aggregate, pane_of
from .rules import Rule


def routed(events: DataFrame, rule: Rule, sets=None) -> DataFrame:
    """group_key, entity, pane, and the aggregates' values of the events that the rule takes: nothing else goes into a shuffle."""
    key, aggs = group_key(rule.keys), compile_all(rule.aggregations)
    values = [c.alias(v) for v, c in {a.v: a.value for a in aggs if a.value is not None}.items()]
    return matching(events, rule, sets).select(key.alias("group_key"), entity(rule.entity_field, key).alias("entity"), pane_of(rule.windowing).alias("pane"), "event_ms", "ingest_ms", "offset", run_of_offsets(), *values)


def windows_of(events: DataFrame, rule: Rule, sets=None) -> DataFrame:
    """group_key, window_start_ms, window_end_ms, the aliases and breached of an active windowed rule; no rows of any other."""
    aggs, w = compile_all(rule.aggregations, names_in(rule.having)), rule.windowing
    rows = routed(events, rule, sets).drop("entity", "event_ms", "ingest_ms")
    if not rule.active or w.stateless:
        rows = rows.where("false")
    out = aggregate(rows, aggs, ["group_key"], F.lit(w.size_ms), F.lit(w.slide), w.slide == w.size_ms)
    return out.where("_raw > 0").withColumn("breached", compile_having(rule.having, over_aliases([a.alias for a in rule.aggregations])))


def results(events: DataFrame, rule: Rule, sets=None) -> DataFrame:
    """Final rows of a windowed rule: rule_id, entity_name, group_key, window_start_ms, window_end_ms, the aliases, breached, is_final.

    A rule whose sink of results is switched off has none.
    """
    out, aliases = windows_of(events, rule, sets), [a.alias for a in rule.aggregations]
    out = out if rule.sinks.agg else out.where("false")
    return out.select(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.entity_name).cast("string").alias("entity_name"), "group_key", "window_start_ms", "window_end_ms", *[F.col(f"`{a}`") for a in aliases], "breached", F.lit(True).alias("is_final"))


def result_rows(rows: DataFrame, aliases: list[str]) -> DataFrame:
    """The output schema of results: times as India's local strings, aggregates as a JSON map."""
    agg = F.to_json(F.create_map(*[c for a in aliases for c in (F.lit(a), F.col(f"`{a}`"))]))
    now = ist_string(F.unix_millis(F.current_timestamp()))
    return rows.select(F.col("rule_id").alias("id"), ist_string(F.col("window_start_ms")).alias("windowStart"), ist_string(F.col("window_end_ms")).alias("windowEnd"), F.col("entity_name").alias("entityName"), F.col("group_key").alias("groupKey"), F.col("group_key").alias("entityValue"), agg.alias("aggResult"), now.alias("producedAt"), F.col("breached").alias("thresholdBreached"), F.col("is_final").alias("isFinal"))


def stateless_anomalies(events: DataFrame, rule: Rule, sets=None) -> DataFrame:
    """A rule without window: each event whose own fields breach the threshold, without any exchange.

    The fields are read once an event, ahead of the threshold, which names each of them several times over.
    """
    key, fields = group_key(rule.keys), {}

    def names(name: str) -> tuple[str, Column]:
        kind, column = over_events(name)
        if kind != "any":
            return kind, column
        fields.setdefault(name, (f"f{len(fields)}", column))
        return kind, F.col(f"_fields.{fields[name][0]}")

    breach = compile_having(rule.having, names)
    rows = matching(events, rule, sets) if rule.active and wanted(rule) else events.where("false")
    if fields:  # a generator is what the optimizer does not copy the fields' expressions across
        rows = rows.withColumn("_fields", F.explode(F.array(F.struct(*[c.alias(a) for a, c in fields.values()]))))
    return rows.where(breach).select(F.lit(rule.rule_id).alias("rule_id"), entity(rule.entity_field, key).alias("entity"), "offset", "event_ms", F.lit(rule.penalty_ttl_seconds).alias("penalty_ttl_seconds"))


def wanted(rule: Rule) -> bool:
    """Whether any sink takes the rule's anomalies."""
    return rule.sinks.anomaly or rule.sinks.anomaly_store


def early_fires(events: DataFrame, rule: Rule, sets=None) -> DataFrame:
    """The first event of each group and pane after which the pane's running aggregates breach: rule_id, group_key, pane, entity, offset.

    Events count in the order of ingestion. A distinct value counts when it is first seen, so no set of values is held; both window passes use one shuffle.
    """
    aggs = compile_all(rule.aggregations)
    pane, order = ["group_key", "pane"], ["ingest_ms", "offset"]
    upto = W.partitionBy(*pane).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = routed(events, rule, sets)
    rows = (rows if rule.active and wanted(rule) and not rule.windowing.stateless else rows.where("false")).repartition(*pane)
    distinct = [a for a in aggs if a.spec.function == "COUNT_DISTINCT"]
    if distinct:
        rows = rows.select("*", *[a.fresh(pane, order) for a in distinct])
    rows = rows.select(*pane, "entity", *order, *[a.running(upto) for a in aggs])
    rows = rows.where(compile_having(rule.having, over_aliases([a.alias for a in rule.aggregations])))
    first = F.min_by(F.struct("entity", "offset", "ingest_ms"), F.struct("ingest_ms", "offset"))
    return rows.groupBy(*pane).agg(first.alias("f")).select(F.lit(rule.rule_id).alias("rule_id"), "group_key", "pane", "f.entity", "f.offset", "f.ingest_ms")


def anomalies(events: DataFrame, rule: Rule, sets=None) -> DataFrame:
    """One anomaly per group and window start: the early one if a pane that starts there fired, else the breach at the end, for the group key.

    With sliding windows an early fire of a pane so takes the place of the whole window that starts with it. A tumbling window breaches at its end
    only if its pane did after the last event, so its early fires are all; sketched counts, which are estimates only at the end, are the exception.
    """
    early = early_fires(events, rule, sets).select("rule_id", "group_key", F.col("pane").alias("start_ms"), "entity", F.lit(True).alias("early"))
    w, penalty = rule.windowing, F.lit(rule.penalty_ttl_seconds)
    if w.slide == w.size_ms and not any(a.function == "COUNT_DISTINCT" and a.high_cardinality for a in rule.aggregations):
        return early.withColumn("penalty_ttl_seconds", penalty)
    final = windows_of(events, rule, sets).where("breached").where(F.lit(wanted(rule))).select(F.lit(rule.rule_id).alias("rule_id"), "group_key", F.col("window_start_ms").alias("start_ms"), F.col("group_key").alias("entity"), F.lit(False).alias("early"))
    both = early.unionByName(final)
    once = both.groupBy("rule_id", "group_key", "start_ms").agg(F.max_by("entity", "early").alias("entity"), F.max("early").alias("early"))
    return once.withColumn("penalty_ttl_seconds", penalty)


def evaluate(events: DataFrame, rules: list[Rule], sets=None) -> DataFrame:
    """Final rows of all active windowed rules, aggregates as a map: rule_id, group_key, window_start_ms, window_end_ms, aggregates, breached.

    The events are scanned once and aggregated together: each becomes a row for every rule it matches, with the rule's key, pane and values. The n-th
    aggregates of all rules share a column where they are of one function, so the width is that of the largest rule, not the sum of all.
    """
    live = [r for r in rules if r.active and not r.windowing.stateless and r.sinks.agg]
    if not live:
        raise ValueError("no active windowed rule")
    compiled, slots = {id(r): compile_all(r.aggregations, names_in(r.having)) for r in live}, {}

    def slot_of(r: Rule, k: int) -> tuple:
        c = compiled[id(r)][k]
        return k, c.spec.function, c.spec.high_cardinality, c.spec.capped, c.ordered

    for r in live:
        for k, spec in enumerate(r.aggregations):
            slots.setdefault(slot_of(r, k), Compiled(replace(spec, alias=f"_slot{len(slots)}"), f"_v{len(slots)}", slot_of(r, k)[-1]))
    ordered = any(c.ordered for c in slots.values())

    def of(r: Rule) -> dict[str, tuple[Compiled, Compiled]]:
        return {s.alias: (Compiled(s, ""), slots[slot_of(r, k)]) for k, s in enumerate(r.aggregations)}

    def hit(n: int, r: Rule) -> Column:
        own = {slot.v: c.value for c, slot in of(r).values() if c.value is not None}
        typed = {c.v: "string" if c.spec.function == "COUNT_DISTINCT" else "double" for c in slots.values() if c.value is not None}
        values = [own.get(v, F.lit(None)).cast(t).alias(v) for v, t in typed.items()]
        w = r.windowing
        return F.struct(F.lit(n).alias("rule_no"), group_key(r.keys).alias("group_key"), F.lit(w.size_ms).cast("long").alias("size"), F.lit(w.slide).cast("long").alias("slide"), pane_of(w).alias("pane"), *([F.col("offset"), run_of_offsets()] if ordered else []), *values)

    hits = [F.when(topic_matches(r.topic) & compile_filter(r.filters, sets), hit(n, r)) for n, r in enumerate(live)]
    rows = events.select(F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h")).select("h.*")
    keys = ["rule_no", "group_key", "size", "slide"]
    out = aggregate(rows, list(slots.values()), keys, F.col("size"), F.col("slide"), all(r.windowing.slide == r.windowing.size_ms for r in live))

    def chosen(of_rule) -> Column:
        return F.coalesce(*[F.when(F.col("rule_no") == n, of_rule(r)) for n, r in enumerate(live)])

    def names(r: Rule):
        known = {a: ("number", F.col(slot.spec.alias)) for a, (_, slot) in of(r).items()}
        return known.get

    packed = chosen(lambda r: F.create_map(*[c for a, (_, slot) in of(r).items() for c in (F.lit(a), F.col(slot.spec.alias))]))
    return out.select(chosen(lambda r: F.lit(r.rule_id)).alias("rule_id"), "group_key", "window_start_ms", "window_end_ms", packed.alias("aggregates"), chosen(lambda r: compile_having(r.having, names(r))).alias("breached"))
