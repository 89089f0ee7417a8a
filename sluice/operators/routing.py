"""Which rules an event goes to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fields import entity, group_key
from ..plans.rules import Rule
from .filters import compile_filter, topic_matches


def matching(events: DataFrame, rule: Rule, sets=None) -> DataFrame:
    """The events of one rule's topic that pass its filters."""
    return events.where(topic_matches(rule.topic) & compile_filter(rule.filters, sets))


def route(events: DataFrame, rules: list[Rule], sets=None) -> DataFrame:
    """(event columns, rule_id, group_key, entity) for every event and active rule that match, from one scan of the events.

    Each rule is one element of an array that is exploded, so the events are read, and their fields extracted, once for all rules.
    """
    active = [r for r in rules if r.active]
    if not active:
        return events.select("*", F.lit("").alias("rule_id"), F.lit("").alias("group_key"), F.lit("").alias("entity")).where("false")
    hits = [F.when(topic_matches(r.topic) & compile_filter(r.filters, sets), F.struct(F.lit(r.rule_id).alias("rule_id"), group_key(r.keys).alias("group_key"), entity(r.entity_field, group_key(r.keys)).alias("entity"))) for r in active]
    hit = F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull()))
    return events.select("*", hit.alias("_hit")).select(*events.columns, "_hit.rule_id", "_hit.group_key", "_hit.entity")


def route_by_union(events: DataFrame, rules: list[Rule], sets=None) -> DataFrame:
    """The same, as a filter per rule and their union: for few rules on a source partitioned by topic."""
    active = [r for r in rules if r.active]
    parts = [matching(events, r, sets).select("*", F.lit(r.rule_id).alias("rule_id"), group_key(r.keys).alias("group_key"), entity(r.entity_field, group_key(r.keys)).alias("entity")) for r in active]
    return reduce(DataFrame.unionByName, parts) if parts else route(events, [])


def of_active(results: DataFrame, live: DataFrame) -> DataFrame:
    """Results whose rule is still active when they are emitted; live: (rule_id, status)."""
    return results.join(live.where(F.upper("status") == "ACTIVE").select("rule_id"), "rule_id", "left_semi")
