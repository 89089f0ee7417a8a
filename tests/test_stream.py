import json
import os

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.catalog import DAY, VALUE, frame, rule
from sluice.plans import batch
from sluice.streaming import queries
from sluice.streaming.stateful import OUTPUT, Evaluator, Panes, evaluate_stream, rules_file, status_file, use_rocksdb

FRAME = "raw string, data string, source_topic string, partition int, offset long, ingest_ms long, event_ms long"


def test_close_late_rows_and_anomalies(spark, tmp_path):
    """One file per micro-batch: a window that fills, two that move the watermark past it, and an event late by its own time."""
    use_rocksdb(spark)
    day = 86_400_000
    off = -19_800_000 % 1000
    batches = [[("a", 100, 100), ("a", 200, 200)], [("a", 5_100, 5_100)], [("a", 5_150, 5_150)], [("a", 300, 5_200)], [("a", 9_000, 9_000)]]
    base = 10 * day - 10 * day % 1000 + off
    os.makedirs(tmp_path / "in")
    for k, rows in enumerate(batches):
        out = pd.DataFrame([("{}", json.dumps({"u": u}), "t", 0, 10 * k + j, base + ka, base + ev) for j, (u, ev, ka) in enumerate(rows)], columns=["raw", "data", "source_topic", "partition", "offset", "ingest_ms", "event_ms"])
        out["partition"] = out["partition"].astype("int32")
        out.to_parquet(tmp_path / "in" / f"{k}.parquet")
        os.utime(tmp_path / "in" / f"{k}.parquet", (1000 + k, 1000 + k))
    stream = spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    r = rule(keys=("_data.u",), size=1000, having="cnt >= 2", windowing={"allowed_lateness_ms": 60_000})
    q = evaluate_stream(stream, r, early_interval_ms=None, watermark="0 seconds").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    rows = spark.read.schema(OUTPUT).parquet(str(tmp_path / "out")).collect()
    final = [(x.window_start_ms - base, json.loads(x.aggregates)["cnt"], x.breached) for x in rows if x.kind == "result" and x.is_final]
    assert (0, 2.0, True) in final
    late = [(x.window_start_ms - base, json.loads(x.aggregates)["cnt"]) for x in rows if x.kind == "result" and not x.is_final]
    assert late == [(0, 3.0)]
    assert sorted((x.window_start_ms - base, x.is_final) for x in rows if x.kind == "anomaly") == [(0, False), (5000, False)]


class SlowQuery:
    """Commits a file with each look at its progress, or fails before the last."""

    def __init__(self, fails: bool):
        self.fails, self.files, self.isActive = fails, 0, True

    @property
    def lastProgress(self):
        self.files += 1
        self.isActive = not (self.fails and self.files == 3)
        return {"numInputRows": 0 if self.files == 2 else 5, "sources": [{"endOffset": '{"logOffset":%d}' % (min(self.files, 3) - 1)}]}


def test_settle_waits_for_every_file(monkeypatch):
    monkeypatch.setattr(time, "sleep", lambda _: None)
    query = SlowQuery(False)
    queries.settle(query, 3)
    assert query.files >= 3
    failed = SlowQuery(True)
    queries.settle(failed, 9)
    assert not failed.isActive


@pytest.mark.parametrize("processing", [False, True])
def test_a_failed_stream_raises(spark, tmp_path, processing):
    at = f"file://{tmp_path}"
    spark.range(6).select(F.col("id").alias("offset")).repartition(2).write.parquet(f"{at}/in")
    stream = spark.readStream.schema("offset long").option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    with pytest.raises(Exception, match="stopped on purpose"):
        queries.finish(stream.select(F.when(F.col("offset") >= 0, F.raise_error(F.lit("stopped on purpose"))).cast("long").alias("x")), at, processing=processing)


def test_replay_goes_by_ingestion_however_its_files_are_written(spark, monkeypatch):
    """The first range is by far the largest, so that its file is finished last."""
    blob = F.when(F.col("id") < 1000, F.expr("array_join(transform(sequence(1, 400), k -> sha2(concat(id, '-', k), 512)), '')")).otherwise("{}")
    rows = spark.range(3000).select(blob.alias("raw"), F.col("id").alias("offset"), (F.col("id") * 60_000).alias("ingest_ms"))
    monkeypatch.setattr("sluice.catalog.frame", lambda spark, sf_dir: rows)
    _, at = queries.replay(spark, "")
    spans = spark.read.parquet(f"{at}/in").groupBy("_metadata.file_modification_time").agg(F.min("ingest_ms").alias("lo"), F.max("ingest_ms").alias("hi"), F.count_distinct("_metadata.file_name").alias("n")).orderBy("file_modification_time").collect()
    assert len(spans) == 3 and all(x.n == 1 for x in spans)
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_streams_equal_the_batch_plan(spark):
    sf = "/root/testdata/sf0.001"
    events = frame(spark, sf)
    last = events.agg(F.max("ingest_ms")).first()[0] - 60_000
    r = rule("s", keys=("event_type",), size=DAY, aggs=(("cnt", "COUNT", None), ("total", "SUM", VALUE)), having="cnt > 3")
    want = {(x.group_key, x.window_start_ms): (x.cnt, x.breached) for x in batch.results(events, r).where(F.col("window_end_ms") <= last).collect()}
    got = queries.stream_tumbling(spark, sf).collect()
    assert len(got) == len(want) and {(x.group_key, x.window_start_ms): (x.cnt, x.breached) for x in got} == want
    r = rule("s", keys=("event_type",), size=DAY // 4, having="cnt >= 5", entity_field="_data.user_id")
    want = {(x.group_key, x.start_ms) for x in batch.anomalies(events, r).collect()}
    got = queries.stream_anomalies(spark, sf).collect()
    assert len(got) == len(want) and {(x.group_key, x.window_start_ms) for x in got} == want


def test_sketched_counts_have_no_cap():
    high = rule(aggs=(("d", "COUNT_DISTINCT", "_data.u", "HIGH"),))
    math = Panes(high)
    panes = [{}, {}]
    for k in range(120_000):
        math.add(panes[k % 2], [f"v{k}"])
        if k in (0, 99, 9_999):
            assert math.merged(panes)["d"] == pytest.approx(k + 1, rel=0.03)
    again = json.loads(json.dumps(panes))
    for k in range(0, 1000):
        math.add(again[0], [f"v{k}"])
    math.add(again[0], [None])
    assert math.merged(again)["d"] == pytest.approx(120_000, rel=0.04)
    assert math.merged(panes[:1])["d"] == pytest.approx(60_000, rel=0.04)
    assert math.merged([{"n": 1}])["d"] == 0.0


def test_exact_counts_stay_exact_and_capped():
    math, pane = Panes(rule(aggs=(("d", "COUNT_DISTINCT", "_data.u"),))), {}
    for v in ("a", "b", "a"):
        math.add(pane, [v])
    assert math.merged([json.loads(json.dumps(pane))])["d"] == 2.0 and list(pane["d"]) == ["a", "b"]
    for k in range(60_000):
        math.add(pane, [str(k)])
    assert math.merged([pane])["d"] == 50_000.0


def run_files(spark, tmp_path, r, batches, **more):
    """Rows of OUTPUT from batches of (group, event ms, ingestion ms), one file each, relative to a pane's start; and that start."""
    use_rocksdb(spark)
    w = r.windowing
    base = 864_000_000 - (864_000_000 - w.offset) % w.slide
    os.makedirs(tmp_path / "in")
    for k, rows in enumerate(batches):
        out = pd.DataFrame([("{}", json.dumps({"u": u}), "t", 0, 1000 * k + j, base + ka, base + ev) for j, (u, ev, ka) in enumerate(rows)], columns=["raw", "data", "source_topic", "partition", "offset", "ingest_ms", "event_ms"])
        out["partition"] = out["partition"].astype("int32")
        out.to_parquet(tmp_path / "in" / f"{k}.parquet")
        os.utime(tmp_path / "in" / f"{k}.parquet", (1000 + k, 1000 + k))
    stream = spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = evaluate_stream(stream, r, watermark="0 seconds", **more).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(OUTPUT).parquet(str(tmp_path / "out")).collect(), base


def test_early_rows_are_throttled(spark, tmp_path):
    r = rule(keys=("_data.u",), size=1000)
    rows, base = run_files(spark, tmp_path, r, [[("a", k, k) for k in range(50)], [("a", 3000, 3000)]], early_interval_ms=3_600_000)
    early = [(x.window_start_ms - base, json.loads(x.aggregates)["cnt"], x.is_final) for x in rows if x.kind == "early"]
    assert early == [(0, 1.0, False)]  # the first event's; the interval lets no other through
    assert [(x.window_start_ms - base, json.loads(x.aggregates)["cnt"]) for x in rows if x.kind == "result"] == [(0, 50.0)]


def test_a_rule_that_is_switched_off_emits_nothing_at_the_close(spark, tmp_path):
    (tmp_path / "status.json").write_text(json.dumps({"other": "ACTIVE"}))
    r = rule(keys=("_data.u",), size=1000)
    rows, _ = run_files(spark, tmp_path, r, [[("a", 10, 10)], [("a", 3000, 3000)], [("a", 6000, 6000)]], early_interval_ms=None, status=status_file(str(tmp_path / "status.json")))
    assert rows == []


class Held:
    """State and timers of one group, in memory."""

    def __init__(self):
        self.maps, self.values, self.timers, self.mark = {}, {}, set(), 0

    def getMapState(self, name, *_):
        held = self.maps.setdefault(name, {})

        class Map:
            containsKey, keys, clear = staticmethod(held.__contains__), staticmethod(lambda: list(held)), staticmethod(held.clear)
            getValue, updateValue, removeKey = staticmethod(held.get), staticmethod(held.__setitem__), staticmethod(held.pop)

        return Map

    def getValueState(self, name, *_):
        values = self.values

        class Value:
            exists, get = staticmethod(lambda: name in values), staticmethod(lambda: values[name])
            update, clear = staticmethod(lambda v: values.__setitem__(name, v)), staticmethod(lambda: values.pop(name, None))

        return Value

    def registerTimer(self, at):
        self.timers.add(at)

    def getCurrentWatermarkInMs(self):
        return self.mark

    def getCurrentProcessingTimeInMs(self):
        return 5

    def getExpiryTimeInMs(self):
        return self.now


def drive(evaluator, held, rows, until):
    """One batch of (event ms, value), then all timers up to ``until``, in order."""
    out = []
    if rows:
        frame = pd.DataFrame([(ms, k, ms, "e") for k, (ms, _) in enumerate(rows)], columns=["ts_ms", "offset", "ingest_ms", "entity"])
        out += list(evaluator.handleInputRows(("g",), iter([frame[:1], frame[1:]]), held))
    held.mark = until
    while due := sorted(t for t in held.timers if t <= until):
        held.timers.discard(due[0])
        held.now = due[0]
        out += list(evaluator.handleExpiredTimer(("g",), held, held))
    return [r for f in out for r in f.to_dict("records")]


def test_state_of_a_rule_that_is_off_goes_after_the_ttl():
    status = {"now": "PAUSED"}
    held, r = Held(), rule(size=1000)
    e = Evaluator(r, 1, lambda _: status["now"], None, ttl_ms=10_000)
    e.init(held)
    off = r.windowing.offset
    assert drive(e, held, [(off + 10, 1), (off + 20, 1)], off + 5_000) == [] and held.maps["panes"]
    assert drive(e, held, [], off + 60_000) == [] and not held.maps["panes"] and not held.timers
    status["now"] = "ACTIVE"
    e.read_at = None
    got = drive(e, held, [(off + 70_010, 1), (off + 95_000, 1)], off + 200_000)
    assert [(x["window_start_ms"] - off, json.loads(x["aggregates"])["cnt"]) for x in got] == [(70_000, 1.0), (95_000, 1.0)]
    assert not held.timers and not held.maps["panes"]


def test_a_sketched_threshold_in_a_stream(spark, tmp_path):
    use_rocksdb(spark)
    day = 86_400_000
    rows = [("{}", json.dumps({"g": "x", "u": str(k % 300)}), "t", 0, k, 10 * day + k, 10 * day + k) for k in range(900)]
    spark.createDataFrame(rows, FRAME).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    r = rule(keys=("_data.g",), aggs=(("d", "COUNT_DISTINCT", "_data.u", "HIGH"),), having="d >= 250")
    q = evaluate_stream(spark.readStream.schema(FRAME).parquet(f"file://{tmp_path}/in"), r, early_interval_ms=None).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    fired = [json.loads(x.aggregates)["d"] for x in spark.read.schema(OUTPUT).parquet(str(tmp_path / "out")).collect() if x.kind == "anomaly"]
    assert len(fired) == 1 and fired[0] == pytest.approx(250, rel=0.05)


def counts(rows, off):
    return sorted((x["window_start_ms"] - off, x["window_end_ms"] - off, json.loads(x["aggregates"]), x["breached"]) for x in rows if x["kind"] == "result")


def test_a_group_takes_a_changed_rule_with_its_next_event():
    now = {"rule": rule(size=1000)}
    held = Held()
    e = Evaluator(now["rule"], 1, None, None, rules=lambda _: now["rule"], columns=[("none", None), ("number", "x")])
    e.init(held)
    off = now["rule"].windowing.offset
    assert drive(e, held, [(off + 10, 1), (off + 20, 1)], off + 500) == []
    now["rule"], e.read_at = rule(size=1000, having="cnt >= 2"), None
    # No event since: the window closes as it was.
    assert counts(drive(e, held, [], off + 1_500), off) == [(0, 1000, {"cnt": 2.0}, False)]
    got = drive(e, held, [(off + 1_600, 1), (off + 1_700, 1)], off + 2_500)
    assert counts(got, off) == [(1000, 2000, {"cnt": 2.0}, True)]


def test_a_changed_grid_keeps_the_panes():
    now = {"rule": rule(size=1000)}
    held = Held()
    e = Evaluator(now["rule"], 1, None, None, rules=lambda _: now["rule"])
    e.init(held)
    off = rule(size=4000).windowing.offset
    assert off % 1000 == now["rule"].windowing.offset
    assert drive(e, held, [(off + 10, 1), (off + 1_010, 1), (off + 2_010, 1)], off + 500) == []
    now["rule"], e.read_at = rule(size=4000), None
    got = drive(e, held, [(off + 3_999, 1), (off + 4_000, 1)], off + 9_000)
    assert counts(got, off) == [(0, 4000, {"cnt": 4.0}, False), (4000, 8000, {"cnt": 1.0}, False)]
    assert drive(e, held, [], off + 20_000) == []
    # Back to a finer grid: what is kept goes to the pane in which it began.
    assert drive(e, held, [(off + 23_000, 1)], off + 20_000) == []
    now["rule"], e.read_at = rule(size=1000), None
    got = drive(e, held, [(off + 23_100, 1)], off + 30_000)
    assert counts(got, off) == [(20_000, 21_000, {"cnt": 1.0}, False), (23_000, 24_000, {"cnt": 1.0}, False)]


def test_an_alias_with_another_source_begins_anew():
    low, high = rule(aggs=(("d", "COUNT_DISTINCT", "u"),), size=1000), rule(aggs=(("d", "COUNT_DISTINCT", "u", "HIGH"), ("cnt", "COUNT", None)), size=1000)
    now, held = {"rule": low}, Held()
    e = Evaluator(low, 1, None, None, rules=lambda _: now["rule"], columns=[("text", "u"), ("sketch", "u")])
    e.init(held)
    off = low.windowing.offset

    def feed(values):
        rows = pd.DataFrame([(off + 10, k, k, "e", v, "v" + v) for k, v in enumerate(values)], columns=["ts_ms", "offset", "ingest_ms", "entity", "v0", "v1"])
        list(e.handleInputRows(("g",), iter([rows]), held))

    feed(["a", "b", "c"])
    now["rule"], e.read_at = high, None
    feed(["d", "e"])
    assert counts(drive(e, held, [], off + 1_500), off) == [(0, 1000, {"d": 2.0, "cnt": 5.0}, False)]


def test_joined_panes_are_those_of_all_events():
    r = rule(aggs=(("n", "COUNT", None), ("s", "SUM", "x"), ("lo", "MIN", "x"), ("d", "COUNT_DISTINCT", "u"), ("h", "COUNT_DISTINCT", "u", "HIGH")))
    math, panes, whole = Panes(r), [{}, {}, {}], {}
    for k in range(300):
        values = [None, float(k), float(k), str(k % 70), str(k % 70)]
        math.add(panes[k // 100], values)
        math.add(whole, values)
    assert math.merged([math.joined(panes)]) == math.merged([whole]) == math.merged(panes)


def test_aliases_are_free():
    """An alias may have the name of anything that a pane holds."""
    math, pane = Panes(rule(aggs=(("n", "SUM", "x"), ("rows", "MAX", "x")))), {}
    for v in (2.0, 3.0):
        math.add(pane, [v, v])
    assert math.merged([json.loads(json.dumps(pane))]) == {"n": 5.0, "rows": 3.0}


def test_a_change_that_needs_another_plan_raises():
    now, held = {"rule": rule(size=1000)}, Held()
    e = Evaluator(now["rule"], 1, None, None, rules=lambda _: now["rule"])
    e.init(held)
    off = now["rule"].windowing.offset
    for other in (rule(size=1000, keys=("_data.other",)), rule(size=1000, aggs=(("s", "SUM", "_data.x"),)), rule(size=1000, topic="elsewhere")):
        now["rule"], e.read_at = other, None
        with pytest.raises(ValueError, match="start the stream again"):
            drive(e, held, [(off + 10, 1)], off + 20)
    now["rule"], e.read_at = rule(size=1000, status="PAUSED"), None
    assert drive(e, held, [(off + 10, 1)], off + 20) == [] and not held.maps["panes"]


def test_rules_change_in_a_running_stream(spark, tmp_path):
    """The same checkpoint, first with one version in the file and then with another: b has no event since, so its window closes as it was."""
    use_rocksdb(spark)
    first, base = rule(keys=("_data.u",), size=1000), 864_000_000
    base -= (base - first.windowing.offset) % 1000

    def publish(having, aggs):
        doc = {"rule_metadata": {"rule_id": "r", "status": "ACTIVE"}, "execution_routing": {"target_source_topic": ""}, "grouping": {"keys": ["_data.u"], "entity_name": "user"}}
        doc |= {"windowing": {"type": "TUMBLING", "time_type": "EVENT_TIME", "size_ms": 1000, "slide_ms": 0}, "aggregations": aggs, "having_thresholds": {"expression": having}}
        (tmp_path / "rules.json").write_text(json.dumps([doc]))

    def run(name, rows):
        out = pd.DataFrame([("{}", json.dumps({"u": u, "x": 5}), "t", 0, at, base + at, base + at) for u, at in rows], columns=["raw", "data", "source_topic", "partition", "offset", "ingest_ms", "event_ms"])
        out["partition"] = out["partition"].astype("int32")
        os.makedirs(tmp_path / "in", exist_ok=True)
        out.to_parquet(tmp_path / "in" / name)
        stream = evaluate_stream(spark.readStream.schema(FRAME).parquet(str(tmp_path / "in")), first, early_interval_ms=None, watermark="0 seconds", rules=rules_file(str(tmp_path / "rules.json")), fields=("_data.x",))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()

    count, total = {"alias": "cnt", "function": "COUNT"}, {"alias": "total", "function": "SUM", "field": "_data.x"}
    publish(None, [count])
    run("0.parquet", [("a", 10), ("b", 20)])
    publish("total >= 5", [count, total])
    run("1.parquet", [("a", 30)])
    run("2.parquet", [("c", 5000)])
    rows = spark.read.schema(OUTPUT).parquet(str(tmp_path / "out")).where("kind = 'result' and is_final").collect()
    got = {x.group_key: (json.loads(x.aggregates), x.breached) for x in rows if x.window_start_ms == base}
    assert got == {"a": ({"cnt": 2.0, "total": 5.0}, True), "b": ({"cnt": 1.0}, False)}
