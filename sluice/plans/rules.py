"""Rules: the query language, its validation, and the registry of live rules."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GLOBAL = "__GLOBAL__"
IST_OFFSET_MS = 19_800_000
DEFAULT_TIME_FIELD = "_event_timestamp_epoch_ms"


@dataclass(frozen=True)
class Windowing:
    type: str | None = None
    time_type: str | None = None
    timestamp_field: str = DEFAULT_TIME_FIELD
    timestamp_format: str = "EPOCH_MILLIS"
    size_ms: int = 0
    slide_ms: int = 0
    allowed_lateness_ms: int = 0
    alignment_offset_ms: int = 0
    use_kafka_timestamp: bool = False

    @property
    def stateless(self) -> bool:
        return (self.type or "").upper() == "NONE"

    @property
    def sliding(self) -> bool:
        return (self.type or "").upper() == "SLIDING"

    @property
    def event_time(self) -> bool:
        return (self.time_type or "").upper() == "EVENT_TIME"

    @property
    def slide(self) -> int:
        return self.slide_ms if self.sliding else self.size_ms

    @property
    def offset(self) -> int:
        """Windows are aligned to India's midnight plus the rule's own offset; the result lies in [0, slide)."""
        return (self.alignment_offset_ms - IST_OFFSET_MS) % self.slide


@dataclass(frozen=True)
class Aggregation:
    alias: str
    function: str
    field: str | None = None
    high_cardinality: bool = False
    #: Whether an exact distinct count stops at so many values of a pane.
    capped: bool = True


@dataclass(frozen=True)
class Sinks:
    agg: bool = True
    anomaly: bool = True
    anomaly_store: bool = True


@dataclass(frozen=True)
class Rule:
    rule_id: str
    status: str = "ACTIVE"
    topic: str = ""
    name: str | None = None
    severity: str | None = None
    penalty_ttl_seconds: int = 0
    filters: dict[str, Any] | None = None
    keys: tuple[str, ...] = ()
    entity_name: str | None = None
    entity_field: str | None = None
    windowing: Windowing | None = None
    aggregations: tuple[Aggregation, ...] = ()
    having: str | None = None
    sinks: Sinks = field(default_factory=Sinks)

    @property
    def active(self) -> bool:
        return self.status.upper() == "ACTIVE"

    @property
    def deleted(self) -> bool:
        return self.status.upper() == "DELETED"


class Rejected(ValueError):
    """Why a rule is not taken."""


def parse(text: str | bytes | None) -> Rule:
    """A rule from its JSON; raises Rejected with the reason. Unknown properties are ignored."""
    if text is None or not text.strip():
        raise Rejected("empty rule")
    try:
        doc = json.loads(text)
    except ValueError as e:
        raise Rejected(f"malformed JSON: {e}") from e
    if not isinstance(doc, dict):
        raise Rejected("not an object")
    try:
        return of(doc)
    except (TypeError, AttributeError, ValueError) as e:
        raise e if isinstance(e, Rejected) else Rejected(f"malformed rule: {e}") from e


def of(doc: dict[str, Any]) -> Rule:
    meta, routing = doc.get("rule_metadata") or {}, doc.get("execution_routing")
    if not meta.get("rule_id"):
        raise Rejected("no rule_id")
    if not routing or routing.get("target_source_topic") is None:
        raise Rejected("no target_source_topic")
    status = str(meta.get("status") or "")
    grouping, win, sinks = doc.get("grouping") or {}, doc.get("windowing"), doc.get("sinks") or {}
    on = lambda k: sinks.get(k, True) is not False
    windowing = None
    if win is not None:
        known = {k: v for k, v in win.items() if k in Windowing.__dataclass_fields__ and v is not None}
        windowing = Windowing(**known)
    aggs = tuple(Aggregation(a["alias"], str(a.get("function") or "").upper(), a.get("field"), str(a.get("cardinality_hint") or "LOW").upper() == "HIGH", a.get("capped") is not False) for a in doc.get("aggregations") or ())
    rule = Rule(
        rule_id=str(meta["rule_id"]),
        status=status,
        topic=str(routing["target_source_topic"]),
        name=meta.get("rule_name"),
        severity=meta.get("severity_level"),
        penalty_ttl_seconds=int(meta.get("penalty_ttl_seconds") or 0),
        filters=doc.get("filters"),
        keys=tuple(grouping.get("keys") or ()),
        entity_name=grouping.get("entity_name"),
        entity_field=grouping.get("anomaly_entity_field"),
        windowing=windowing,
        aggregations=aggs,
        having=(doc.get("having_thresholds") or {}).get("expression"),
        sinks=Sinks(on("agg_sink_enabled"), on("anomaly_sink_enabled"), on("anomaly_store_sink_enabled")),
    )
    if not rule.deleted:
        if not rule.keys:
            raise Rejected("no grouping keys")
        if windowing is None:
            raise Rejected("no windowing")
        if not windowing.stateless:
            if not aggs:
                raise Rejected("no aggregations")
            if windowing.size_ms <= 0 or windowing.slide <= 0:
                raise Rejected("window size and slide must be positive")
            if len({a.alias for a in aggs}) < len(aggs):
                raise Rejected("an alias is used twice")
    return rule


def accepted(texts: list[str | None]) -> tuple[list[Rule], list[tuple[str | None, str]]]:
    """(rules, rejected texts with reasons)."""
    good, bad = [], []
    for text in texts:
        try:
            good.append(parse(text))
        except Rejected as e:
            bad.append((text, str(e)))
    return good, bad


def registry(rules: list[Rule]) -> dict[str, Rule]:
    """Live rules by id after upserts in order: a deleted rule goes, a paused one stays without being active."""
    live: dict[str, Rule] = {}
    for rule in rules:
        live.pop(rule.rule_id, None)
        if not rule.deleted:
            live[rule.rule_id] = rule
    return live


def latest(updates: DataFrame, order: str = "offset") -> DataFrame:
    """The registry over a table of rule updates (rule_id, status, ..., order): the last update per rule, deleted ones left out."""
    last = W.partitionBy("rule_id").orderBy(F.col(order).desc())
    return updates.withColumn("_n", F.row_number().over(last)).where((F.col("_n") == 1) & (F.upper(F.coalesce("status", F.lit(""))) != "DELETED")).drop("_n")
