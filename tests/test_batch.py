"""Plans against a small simulator written from the rules' definition, on random events."""

import json
import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sluice.catalog import SPECS, rule
from sluice.operators.dedup import dedup_ttl
from sluice.plans import batch
from sluice.plans.rules import Sinks
from sluice.sources.events import decode
from sluice.sources.sinks import in_batches, penalties, retrying

OFFSET = -19_800_000


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        data = {"u": rng.choice("abc"), "v": rng.choice([1, 2.5, "3", "x", None, -4]), "n": rng.choice(["", "p", "q", None])}
        rows.append((json.dumps({"_event_timestamp": None, "_data": data}), "t", 0, k, rng.randrange(1, 5000)))
    df = decode(spark.createDataFrame(rows, "value string, topic string, partition int, offset long, timestamp long"))
    return df.cache(), [(json.loads(r[0])["_data"], r[4], r[3]) for r in rows]


def simulate(rows, size, slide):
    off = OFFSET % slide
    buckets = defaultdict(list)
    for data, ms, _ in rows:
        buckets[data["u"], (ms - off) // slide * slide + off].append(data)
    out = {}
    for (u, b), _ in buckets.items():
        for k in range(1, size // slide + 1):
            end = b + k * slide
            inside = [d for (x, c), ds in buckets.items() if x == u and end - size <= c < end for d in ds]
            nums = [float(d["v"]) for d in inside if d["v"] not in (None, "x")]
            out[u, end] = (len(inside), sum(nums), sum(nums) / len(nums) if nums else 0, min(nums, default=0), max(nums, default=0), len({d["n"] for d in inside} - {"", None}))
    return out


@pytest.mark.parametrize(("size", "slide"), [(1000, 1000), (1000, 250), (1000, 300), (200, 500)])
def test_windows(events, size, slide):
    v = "_data.v"
    r = rule(keys=("_data.u",), kind="SLIDING", size=size, slide=slide, aggs=(("c", "COUNT", None), ("s", "SUM", v), ("m", "AVG", v), ("lo", "MIN", v), ("hi", "MAX", v), ("d", "COUNT_DISTINCT", "_data.n")))
    got = {(x.group_key, x.window_end_ms): (x.c, x.s, x.m, x.lo, x.hi, x.d) for x in batch.results(events[0], r).collect()}
    want = simulate(events[1], size, slide)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_tumbling_is_sliding_with_a_slide_of_its_size(events):
    spec = (("c", "COUNT", None), ("d", "COUNT_DISTINCT", "_data.n"))
    a = batch.results(events[0], rule(keys=("_data.u",), size=1000, aggs=spec))
    b = batch.results(events[0], rule(keys=("_data.u",), size=1000, slide=1000, kind="SLIDING", aggs=spec))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_early_fire_and_one_anomaly_per_window(events):
    r = rule(keys=("_data.u",), size=1000, having="cnt >= 10", entity_field="_data.n", ttl=9)
    want, counts = {}, defaultdict(int)
    for data, ms, k in sorted(events[1], key=lambda x: (x[1], x[2])):
        at = (data["u"], (ms - OFFSET % 1000) // 1000 * 1000 + OFFSET % 1000)
        counts[at] += 1
        if counts[at] == 10:
            want[at] = (k, data["u"] if data["n"] is None else data["n"])
    got = {(x.group_key, x.pane): (x.offset, x.entity) for x in batch.early_fires(events[0], r).collect()}
    assert got == want
    once = batch.anomalies(events[0], r).collect()
    assert {(x.group_key, x.start_ms): x.entity for x in once} == {k: v[1] for k, v in want.items()} and all(x.early for x in once)


def test_rules_evaluated_together_give_what_each_gives_alone(events):
    v = "_data.v"
    rules = [
        rule("a", keys=("_data.u",), size=1000, aggs=(("c", "COUNT", None), ("s", "SUM", v), ("d", "COUNT_DISTINCT", "_data.n")), having="c > 20 && d > 1"),
        rule("b", keys=("_data.n",), kind="SLIDING", size=1000, slide=300, aggs=(("m", "AVG", v), ("lo", "MIN", v), ("d", "COUNT_DISTINCT", "_data.u"), ("h", "COUNT_DISTINCT", "_data.u", "HIGH")), having="m > 1"),
        rule("c", kind="SLIDING", size=200, slide=500),
        rule("p", status="PAUSED"),
    ]
    got = {(x.rule_id, x.group_key, x.window_end_ms): (x.window_start_ms, x.breached, x.aggregates) for x in batch.evaluate(events[0], rules).collect()}
    want = {}
    for r in rules:
        for x in batch.results(events[0], r).collect():
            want[r.rule_id, x.group_key, x.window_end_ms] = (x.window_start_ms, x.breached, {a.alias: pytest.approx(x[a.alias]) for a in r.aggregations})
    assert got == want and {k[0] for k in got} == {"a", "b"}
    plan = batch.evaluate(events[0], rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 1
    only = batch.evaluate(events[0], rules[:1])
    assert only.count() == sum(k[0] == "a" for k in got)


def test_distinct_counts_have_one_cap(events, monkeypatch):
    """At most so many values of a pane, however the window is cut; early fires count up to it, too."""
    monkeypatch.setattr("sluice.operators.aggregates.DISTINCT_CAP", 2)
    monkeypatch.setattr("sluice.operators.windows.DISTINCT_CAP", 2)
    spec = (("d", "COUNT_DISTINCT", "_data.v"),)
    high = lambda **w: {x.d for x in batch.results(events[0], rule(keys=("_data.u",), aggs=spec, **w)).collect()}
    assert max(high(size=1000)) == 2 and max(high(kind="SLIDING", size=1000, slide=999)) == 2 and max(high(kind="SLIDING", size=1000, slide=500)) == 4
    assert batch.early_fires(events[0], rule(keys=("_data.u",), size=1000, aggs=spec, having="d > 2")).count() == 0


def test_sketched_counts_are_held_against_all_distinct_values(spark, events, monkeypatch):
    """However many values a capped count would keep: alone, in sliding windows, in early fires, and beside a capped one of the same field."""
    monkeypatch.setattr("sluice.operators.aggregates.DISTINCT_CAP", 2)
    monkeypatch.setattr("sluice.operators.windows.DISTINCT_CAP", 2)
    for name in ("agg_hll", "agg_hll_sliding"):
        rows = SPECS[name][0](spark, "/root/testdata/sf0.001").collect()
        assert rows and all(x.close for x in rows)
    spec = (("d", "COUNT_DISTINCT", "_data.v", "LOW", False), ("c", "COUNT_DISTINCT", "_data.v"))
    whole, capped = rule("w", keys=("_data.u",), size=1000, aggs=spec, having="d > 2"), rule("c", keys=("_data.u",), size=1000, aggs=spec[::-1])
    slid = replace(whole, windowing=replace(whole.windowing, type="SLIDING", slide_ms=250))
    assert max(x.d for x in batch.results(events[0], whole).collect()) == max(x.d for x in batch.results(events[0], slid).collect()) == 5
    assert {(x.aggregates["d"] > 2, x.aggregates["c"] > 2) for x in batch.evaluate(events[0], [whole, capped]).collect() if x.aggregates["d"] > 2} == {(True, False)}
    assert batch.early_fires(events[0], whole).count() > 0


@pytest.fixture(scope="module")
def tenths(spark):
    """0.1 + 0.2 + 0.3 is above 0.6 in doubles, 0.3 + 0.2 + 0.1 is not; each group has one order by offset, and rows come in the other."""
    rows = [(json.dumps({"_data": {"u": f"{'up' if g % 2 else 'down'}{g}", "v": v, "n": n}}), "t", 0, 70_000 * k + g, 100) for g in range(40) for k, (v, n) in enumerate([(0.1, "p"), (0.2, "q"), (0.3, "p")][:: 1 if g % 2 else -1])]
    df = decode(spark.createDataFrame(rows, "value string, topic string, partition int, offset long, timestamp long"))
    return df.repartitionByRange(1, F.col("offset").desc()).sortWithinPartitions(F.col("offset").desc()).cache()


@pytest.mark.parametrize("distinct", [(), (("d", "COUNT_DISTINCT", "_data.n"),)])
@pytest.mark.parametrize("having", ["total > 0.6 && c == 3", "total / c * 2 - low > high", "mean > 0.2"])
def test_thresholds_see_sums_by_offset(tenths, having, distinct):
    """In windows of any kind, with any other aggregates, alone or among other rules."""
    v = "_data.v"
    aggs = (("c", "COUNT", None), ("total", "SUM", v), ("mean", "AVG", v), ("low", "MIN", v), ("high", "MAX", v), *distinct)
    r = rule("r", keys=("_data.u",), size=1000, aggs=aggs, having=having)
    slid = replace(r, rule_id="s", windowing=replace(r.windowing, type="SLIDING", slide_ms=250))
    for out in (batch.results(tenths, r), batch.results(tenths, slid), batch.results(tenths.repartition(3), r), batch.evaluate(tenths, [r, slid]), batch.evaluate(tenths, [r, rule("x", keys=("_data.u",), size=500, aggs=aggs[::-1])]).where("rule_id = 'r'")):
        rows = out.collect()
        assert len(rows) in (40, 160, 200) and {(x.group_key[:2], x.breached) for x in rows} == {("up", True), ("do", False)}


def test_long_runs_are_added_up_alike_however_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr("sluice.operators.aggregates.TERMS", 5)
    monkeypatch.setattr("sluice.operators.aggregates.RUN_BITS", 4)
    rng = random.Random(5)
    values = [round(rng.expovariate(0.02), 2) for _ in range(1000)]
    rows = [(json.dumps({"_data": {"u": "hot" if k % 8 else f"cold{k % 5}", "v": v}}), "t", 0, k, 100) for k, v in enumerate(values)]
    df = decode(spark.createDataFrame(rows, "value string, topic string, partition int, offset long, timestamp long"))
    r = rule(keys=("_data.u",), size=1000, aggs=(("c", "COUNT", None), ("total", "SUM", "_data.v"), ("mean", "AVG", "_data.v")), having="total > 1 || mean > 1")
    got = [{x.group_key: (x.c, x.total, x.mean) for x in batch.results(d, r).collect()} for d in (df, df.repartition(7), df.orderBy(F.col("offset").desc()))]
    assert got[0] == got[1] == got[2] and got[0]["hot"][:2] == pytest.approx((875, sum(v for k, v in enumerate(values) if k % 8)))
    for u in range(5):
        total = 0.0
        for k in range(0, 1000, 8):
            total += values[k] if k % 5 == u else 0.0
        assert got[0][f"cold{u}"] == (25, total, total / 25)


def test_early_distinct_counts_and_sinks(events):
    r = rule(keys=("_data.u",), size=1000, aggs=(("d", "COUNT_DISTINCT", "_data.n"), ("c", "COUNT", None)), having="d >= 2 && c >= 3")
    seen, count, want = defaultdict(set), defaultdict(int), {}
    for data, ms, k in sorted(events[1], key=lambda x: (x[1], x[2])):
        at = (data["u"], (ms - OFFSET % 1000) // 1000 * 1000 + OFFSET % 1000)
        count[at] += 1
        seen[at] |= {data["n"]} - {"", None}
        if len(seen[at]) >= 2 and count[at] >= 3:
            want.setdefault(at, k)
    assert {(x.group_key, x.pane): x.offset for x in batch.early_fires(events[0], r).collect()} == want
    off = replace(r, sinks=Sinks(False, False, False))
    assert batch.results(events[0], off).count() == 0 and batch.anomalies(events[0], off).count() == 0
    assert batch.anomalies(events[0], replace(r, sinks=Sinks(False, False, True))).count() == len(want)
    sliding = rule(keys=("_data.u",), kind="SLIDING", size=1000, slide=500, aggs=(("c", "COUNT", None),), having="c >= 1")
    assert batch.anomalies(events[0], replace(sliding, sinks=Sinks(True, False, False))).count() == 0 < batch.anomalies(events[0], sliding).count()


def test_dedup_refreshes(spark):
    rows = spark.createDataFrame([("k", 0, 1), ("k", 8, 2), ("k", 16, 3), ("k", 27, 4), (None, 1, 5), ("", 1, 6)], "k string, ingest_ms long, offset long")
    assert sorted(r.offset for r in dedup_ttl(rows, F.col("k"), 10).collect()) == [1, 4]


def test_penalties_and_writers(spark):
    rows = spark.createDataFrame([("r", "a", 1000, 0), ("r", "b", 1000, -1), ("r", "c", 1000, 5), ("r", "c", 900, 900)], "rule_id string, entity string, produced_ms long, penalty_ttl_seconds int")
    assert {(x.entity, x.expires_ms) for x in penalties(rows).collect()} == {("a", 3_601_000), ("b", None), ("c", 6_000)}
    assert {x.entity for x in penalties(rows, 6_000).collect()} == {"a", "b"}
    sent, tries = [], []

    def send(batch):
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        sent.append(list(batch))

    assert in_batches(iter("abc"), retrying(send, sleep=lambda s: None), 2) == 3 and sent == [["a", "b"], ["c"]]
    with pytest.raises(ValueError):
        retrying(lambda b: (_ for _ in ()).throw(ValueError()), (ValueError,))(["x"])
