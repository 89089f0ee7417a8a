import json

import pytest

from sluice.plans.rules import Rejected, accepted, of, parse, registry

GOOD = {
    "rule_metadata": {"rule_id": "r1", "status": "active", "penalty_ttl_seconds": 600, "more": 1},
    "execution_routing": {"target_source_topic": "events"},
    "grouping": {"keys": ["_data.user_id"]},
    "windowing": {"type": "SLIDING", "time_type": "EVENT_TIME", "size_ms": 600, "slide_ms": 200},
    "aggregations": [{"alias": "cnt", "function": "count", "cardinality_hint": "high"}],
}


def but(**more):
    return json.dumps(GOOD | more)


def test_a_rule_is_read():
    r = parse(json.dumps(GOOD))
    assert r.active and r.windowing.slide == 200 and r.windowing.event_time and r.aggregations[0].high_cardinality and r.aggregations[0].function == "COUNT"
    assert r.sinks.agg and r.sinks.anomaly and r.windowing.offset == -19_800_000 % 200


@pytest.mark.parametrize(
    "text",
    [None, "", "{", "[]", but(rule_metadata={}), but(execution_routing=None), but(execution_routing={"target_source_topic": None}), but(grouping={"keys": []}), but(aggregations=[]), but(windowing=None), but(windowing={"type": "TUMBLING", "size_ms": 0}), but(aggregations=[{"alias": "a", "function": "SUM"}] * 2)],
)
def test_bad_rules_are_rejected(text):
    with pytest.raises(Rejected):
        parse(text)
    assert accepted([text, json.dumps(GOOD)])[0] == [parse(json.dumps(GOOD))]


def test_what_is_accepted_all_the_same():
    deleted = {"rule_metadata": {"rule_id": "x", "status": "DELETED"}, "execution_routing": {"target_source_topic": ""}}
    assert of(deleted).deleted
    assert parse(but(windowing={"type": "NONE"}, aggregations=[])).windowing.stateless
    assert parse(but(execution_routing={"target_source_topic": ""})).topic == ""


def test_registry():
    a, b = parse(but()), parse(but(rule_metadata={"rule_id": "r1", "status": "PAUSED"}))
    gone = of({"rule_metadata": {"rule_id": "r1", "status": "DELETED"}, "execution_routing": {"target_source_topic": ""}})
    assert registry([a, b]) == {"r1": b} and not b.active
    assert registry([a, gone]) == {} and registry([gone, a]) == {"r1": a}
