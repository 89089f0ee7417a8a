import json

import pytest
from pyspark.sql import functions as F

from sluice.catalog import cond
from sluice.functions.having import compile_having, evaluate, over_aliases, over_events
from sluice.functions.times import floor_to_slide, iso_ms, ist_string
from sluice.operators.filters import compile_filter
from sluice.sources.events import decode

EVENT = {"s": "MiXed", "n": "10.0", "e": "", "z": None, "nan": "NaN", "d": "2024-01-01T00:00:00Z", "neg": "-5", "a.b": 1, "_data": {"x": {"y": 7}, "l": [1]}}

TRUTH = [
    ("s", "EQUALS", "mixed", True), ("n", "EQUALS", 10, True), ("n", "EQUALS", "1e1", True), ("nan", "EQUALS", "NaN", True), ("missing", "EQUALS", "", False),
    ("s", "NOT_EQUALS", "mixed", False), ("n", "NOT_EQUALS", 10, False), ("n", "NOT_EQUALS", "x", True), ("missing", "NOT_EQUALS", "x", True), ("z", "NOT_EQUALS", "x", True), ("nan", "NOT_EQUALS", 1, True),
    ("n", "GREATER_THAN", 9, True), ("n", "GREATER_THAN", 10, False), ("n", "GREATER_THAN_EQUAL", 10, True), ("n", "LESS_THAN", 11, True), ("n", "LESS_THAN_EQUAL", 9, False), ("s", "LESS_THAN", 11, False), ("nan", "GREATER_THAN", 1, False),
    ("s", "IN", ["MIXED", 1], True), ("n", "IN", [10], False), ("s", "IN", "mixed", False), ("s", "IN", [], False),
    ("s", "REGEX", "[A-Za-z]+", True), ("s", "REGEX", "Mi", False), ("s", "REGEX", "([", False), ("s", "REGEX", "Mi|MiXed", True),
    ("s", "CONTAINS", "IXE", True), ("s", "CONTAINS", "", True), ("missing", "CONTAINS", "", False), ("s", "NOT_CONTAINS", "q", True), ("missing", "NOT_CONTAINS", "q", False),
    ("s", "STARTS_WITH", "mi", True), ("s", "ENDS_WITH", "ED", True), ("missing", "IS_NULL", None, True), ("z", "IS_NULL", None, True), ("e", "IS_NULL", None, False), ("e", "IS_NOT_NULL", None, True),
    ("neg", "DATE_BEFORE", "5", False), ("n", "DATE_AFTER", "5", True), ("s", "UNKNOWN", "x", False), ("s", "", "x", False), ("", "IS_NULL", None, True),
    ("a.b", "EQUALS", 1, True), ("_data.x.y", "EQUALS", 7, True), ("_data.x.q", "IS_NULL", None, True), ("_data.l.0", "IS_NULL", None, True),
]


@pytest.fixture(scope="module")
def events(spark):
    raw = json.dumps(EVENT)
    return decode(spark.createDataFrame([(raw, "t", 0, 1, 1000)], "value string, topic string, partition int, offset long, timestamp long")).cache()


def test_truth_table(events):
    columns = [compile_filter(cond(f, op, v)).alias(f"c{k}") for k, (f, op, v, _) in enumerate(TRUTH)]
    got = events.select(*columns).first()
    assert [(t, g) for t, g in zip(TRUTH, got, strict=True) if g != t[3]] == []


def test_dates(events):
    for op, v, want in (("DATE_EQUALS", "2024-01-01T05:30:00", True), ("DATE_BEFORE", "2024-01-02T00:00:00Z", True), ("DATE_AFTER", "2024-01-01", False)):
        assert events.select(compile_filter(cond("d", op, v, format="ISO_STRING"))).first()[0] is want


EXPRESSIONS = [("cnt >= 3 && t > 1", True), ("cnt lt 3 or t eq 2.5", True), ("not (cnt > 1)", False), ("nothing == null", True), ("nothing < 1", False), ("nothing + cnt == 4", True), ("cnt / 0 == 0", True), ("cnt", False), ("cnt >", False), ("cnt > 3 ? t > 2 : t > 9", True), ("-cnt < 0", True), ("cnt % 3 == 1", True), ("'abc' =~ 'a.c'", True), ("a.b()", False),
    ("'abc' !~ 'a'", True), ("'abc' =^ 'ab'", True), ("'abc' !^ 'b'", True), ("'abc' =$ 'bc'", True), ("'abc' !$ 'bc'", False), ("cnt =^ 'a'", False), ("empty(nothing) && !empty(cnt) && empty('')", True), ("size('abc') == 3 && size nothing == 0", True),
    ("(nothing ?? cnt) == 4", True), ("(0 ?: t) == 2.5", True), ("cnt == '4.0'", True), ("cnt == 'x' || cnt != 'x'", False), ("true == 'TRUE'", True), ("cnt > 3 ? 'yes' : false", False), ("nothing != null", False), ("null == null", True), ("true > false", True), ("cnt > 1 ? t > 1 : 5", True), ("(cnt > 9 ? 1 : 'a') == 'a'", True)]


def test_thresholds_compiled_and_plain_agree(spark):
    rows = spark.createDataFrame([(4.0, 2.5)], "cnt double, t double")
    got = rows.select(*[compile_having(e, over_aliases(["cnt", "t"])).alias(f"c{k}") for k, (e, _) in enumerate(EXPRESSIONS)]).first()
    assert list(got) == [w for _, w in EXPRESSIONS]
    assert [evaluate(e, {"cnt": 4.0, "t": 2.5}) for e, _ in EXPRESSIONS] == [w for _, w in EXPRESSIONS]


def test_thresholds_over_events_go_by_their_json_types(spark):
    event = {"a": 9, "b": 10, "c": "10.0", "f": 1.0, "i": 1, "ok": True, "no": False, "z": None, "s": "x", "l": [1], "o": {"k": 1}, "_data": {"k": 1}}
    events = decode(spark.createDataFrame([(json.dumps(event), "t", 3, 1, 1000)], "value string, topic string, partition int, offset long, timestamp long"))
    table = {"a > b": False, "b > a": True, "b == c": True, "f == i": True, "ok == true": True, "ok": True, "no": False, "ok && !no": True, "ok == i": True, "z == null": True, "z != null": False, "missing == z": True, "z < 1": False, "s > 1": False, "s != 1": False, "s == 'x'": True,
        "l == null": False, "l == '[1]'": False, "o.k == 1": False, "a + b == 19": True, "z + a == 9": True, "c > 9": True, "'9' > c": True, "-a < 0": True, "s ? a > 1 : b > 1": True, "(ok ? a : s) == 9": True, "a": False, "_kafka_offset == 1 && _kafka_partition == 3": True, "size(s) == 1": True, "empty(z) && empty(missing)": True}
    each, got = list(table), []
    for lo in range(0, len(each), 8):
        got += events.select(*[compile_having(e, over_events).alias(f"c{k}") for k, e in enumerate(each[lo : lo + 8])]).first()
    assert {e: g for e, g, w in zip(table, got, table.values(), strict=True) if g != w} == {}


def test_a_set_under_an_operators_own_name(spark):
    rows = decode(spark.createDataFrame([('{"_data": {"aua": "%s"}}' % a, "t", 0, k, 5) for k, a in enumerate("abc")], "value string, topic string, partition int, offset long, timestamp long"))
    node = cond("whatever", "IS_FINANCIAL_AUA", "ignored")
    assert [r.offset for r in rows.where(compile_filter(node, {"IS_FINANCIAL_AUA": frozenset("ac")})).collect()] == [0, 2]
    assert rows.where(compile_filter(node)).count() == 0


def test_times(spark):
    rows = spark.createDataFrame([(-5,), (7,)], "ms long")
    assert [r[0] for r in rows.select(floor_to_slide(F.col("ms"), 3, 1)).collect()] == [-5, 7]
    texts = spark.createDataFrame([("1970-01-01T05:30:00",), ("1970-01-01T00:00:00.001Z",), ("1970-01-01",), ("x",), (None,)], "t string")
    assert [r[0] for r in texts.select(iso_ms(F.col("t"))).collect()] == [0, 1, None, None, None]
    assert rows.select(ist_string(F.lit(0))).first()[0] == "1970-01-01 05:30:00"


def test_malformed_records_go(spark):
    values = [None, "", "{bad", "[1]", "1", '{"_data": "{\\"x\\": 1}"}']
    rows = spark.createDataFrame([(v, "t", 0, k, 5) for k, v in enumerate(values)], "value string, topic string, partition int, offset long, timestamp long")
    assert [(r.offset, r.data, r.event_ms) for r in decode(rows).collect()] == [(5, '{"x": 1}', 5)]
