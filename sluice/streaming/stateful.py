"""Stateful operators for streams: refreshed-TTL deduplication and the windowed rule evaluator.

Both run with ``transformWithStateInPandas`` on the RocksDB state store. State is kept per pane, in one map, so an
evaluation reads the panes of its window and no others; a batch reads and writes each pane it touches once.
"""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import having
from ..functions.fields import entity, group_key
from ..operators.aggregates import DISTINCT_CAP, HLL_BITS, compile_all
from ..operators.routing import matching
from ..operators.windows import event_time
from ..plans.rules import Aggregation, Rejected, Rule, Sinks, Windowing, of

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DEDUP_TTL_MS = 900_000
EARLY_INTERVAL_MS = 3_000
STATE_TTL_MS = 7_200_000
WATERMARK = "60 seconds"
OUTPUT = "rule_id string, kind string, group_key string, entity string, window_start_ms long, window_end_ms long, aggregates string, breached boolean, is_final boolean"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class Dedup(StatefulProcessor):
    """Emits the first event of a key, and the next one once no event has come for the TTL: repeats refresh the state."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, first = self.seen.exists(), None
        for part in rows:
            if not known and len(part):
                least = part.drop(columns="_key", errors="ignore").sort_values(["ingest_ms", "offset"]).iloc[:1]
                at = tuple(least[["ingest_ms", "offset"]].iloc[0])
                first = (at, least) if first is None or at < first[0] else first
        if first is not None:
            yield first[1]
        self.seen.update((timerValues.getCurrentProcessingTimeInMs(),))

    def close(self) -> None:
        pass


def dedup_stream(events: DataFrame, key, ttl_ms: int = DEDUP_TTL_MS) -> DataFrame:
    """A stream's events without repeats of ``key`` within the TTL of processing time; null and empty keys go."""
    rows = events.withColumn("_key", key).where("_key is not null and _key <> ''")
    return rows.groupBy("_key").transformWithStateInPandas(statefulProcessor=Dedup(ttl_ms), outputStructType=events.schema, outputMode="Append", timeMode="processingTime")


#: A sketch without values: a character per register, "0" plus its rank, as that is short in JSON.
NO_RANKS = "0" * (1 << HLL_BITS)


def offer(sketch: str, value: str) -> str:
    """A HyperLogLog sketch with one more value, from 64 bits of its hash."""
    h = int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
    at, rest = h >> (64 - HLL_BITS), h & ((1 << (64 - HLL_BITS)) - 1)
    rank = chr(48 + 64 - HLL_BITS - rest.bit_length() + 1)
    return sketch if sketch[at] >= rank else sketch[:at] + rank + sketch[at + 1 :]


def cardinality(sketches: list[str]) -> float:
    """The estimate over the union of sketches; counted by empty registers where the estimate is small."""
    ranks = np.max([np.frombuffer(s.encode(), np.uint8) for s in sketches], axis=0) - 48
    m, empty = len(ranks), int((ranks == 0).sum())
    raw = 0.7213 / (1 + 1.079 / m) * m * m / np.ldexp(1.0, -ranks.astype(np.int32)).sum()
    return float(round(m * math.log(m / empty) if empty and raw <= 2.5 * m else raw))


#: A pane's number of events, beside its partials by alias, none of which has a NUL.
ROWS = "\0rows"


def source(spec: Aggregation) -> tuple[str, str | None]:
    """What an aggregate reads from an event: aggregates of one source share a column."""
    if spec.function == "COUNT_DISTINCT":
        return ("sketch" if spec.high_cardinality else "text"), spec.field
    return ("number", spec.field) if spec.function in ("SUM", "AVG", "MIN", "MAX") else ("none", None)


def snapshot(rule: Rule) -> str:
    """The part of a rule that a group's state holds."""
    return json.dumps({"windowing": asdict(rule.windowing), "aggregations": [asdict(a) for a in rule.aggregations], "having": rule.having, "sinks": asdict(rule.sinks)}, sort_keys=True)


def restored(rule: Rule, text: str) -> Rule:
    held = json.loads(text)
    return replace(rule, windowing=Windowing(**held["windowing"]), aggregations=tuple(Aggregation(**a) for a in held["aggregations"]), having=held["having"], sinks=Sinks(**held["sinks"]))


class Panes:
    """Partials of one group's panes as plain values; what the state map holds as JSON."""

    def __init__(self, rule: Rule):
        self.rule, self.w = rule, rule.windowing

    def floor(self, ms: int) -> int:
        return ms - (ms - self.w.offset) % self.w.slide

    def add(self, pane: dict, values: list) -> None:
        pane[ROWS] = pane.get(ROWS, 0) + 1
        for spec, v in zip(self.rule.aggregations, values, strict=True):
            if v is None or isinstance(v, float) and math.isnan(v):
                continue
            f = spec.function
            if f in ("SUM", "AVG", "MIN", "MAX"):
                s, c, lo, hi = pane.get(spec.alias, (0.0, 0, math.inf, -math.inf))
                pane[spec.alias] = (s + v, c + 1, min(lo, v), max(hi, v))
            elif f == "COUNT_DISTINCT" and spec.high_cardinality:
                pane[spec.alias] = offer(pane.get(spec.alias, NO_RANKS), v)
            elif f == "COUNT_DISTINCT":
                held = pane.setdefault(spec.alias, {})  # a dict keeps the order of arrival, is looked up in one step, and goes into JSON as its keys
                if len(held) < DISTINCT_CAP or not spec.capped:
                    held[v] = 1

    def joined(self, panes: list[dict]) -> dict:
        """Panes in order of time as one."""
        out = {ROWS: sum(p[ROWS] for p in panes)}
        for spec in self.rule.aggregations:
            parts, kind = [p[spec.alias] for p in panes if spec.alias in p], source(spec)[0]
            if kind == "none" or not parts:
                continue
            if kind == "sketch":
                out[spec.alias] = "".join(map(max, *parts)) if len(parts) > 1 else parts[0]
            elif kind == "text":
                out[spec.alias] = dict.fromkeys(list(dict.fromkeys(v for p in parts for v in p))[: DISTINCT_CAP if spec.capped else None], 1)
            else:
                s, c, lo, hi = zip(*parts, strict=True)
                out[spec.alias] = (sum(s), sum(c), min(lo), max(hi))
        return out

    def merged(self, panes: list[dict]) -> dict[str, float]:
        out = {}
        for spec in self.rule.aggregations:
            f, parts = spec.function, [p[spec.alias] for p in panes if spec.alias in p]
            if f == "COUNT":
                out[spec.alias] = float(sum(p[ROWS] for p in panes))
            elif f == "COUNT_DISTINCT" and spec.high_cardinality:
                out[spec.alias] = cardinality(parts) if parts else 0.0
            elif f == "COUNT_DISTINCT":
                out[spec.alias] = float(len({v for p in parts for v in p}))
            elif f in ("SUM", "AVG", "MIN", "MAX") and parts:
                s, c = sum(p[0] for p in parts), sum(p[1] for p in parts)
                out[spec.alias] = {"SUM": s, "AVG": s / c if c else 0.0, "MIN": min(p[2] for p in parts), "MAX": max(p[3] for p in parts)}[f]
            else:
                out[spec.alias] = 0.0
        return out


class Evaluator(StatefulProcessor):
    """One windowed rule: final rows when windows close, rows for late events, early and final anomalies, throttled partial rows.

    A window closes when the watermark passes its end, or for processing-time rules when the wall clock does. Panes before the window less the
    allowed lateness are dropped then, of all aliases. A late event within the lateness emits its window again at once, not final;
    one beyond it is still added, and its timer makes a second final row. ``status`` gives the rule's present status at a close (None: unknown, as it was):
    results of a rule that is no longer active are not emitted. State of a group without events for ``ttl_ms`` goes.

    ``rules`` gives the rule as it is now (None: unknown, as it was) and takes the place of ``status``. A group takes a changed rule with its next event and
    holds that snapshot for its timers; only the status is looked up at a close. Events of a rule that isn't active are left out. On another grid of panes
    a kept pane goes, whole, where it began, and windows that end on the old grid no longer close; an alias with another source begins anew.
    """

    def __init__(
        self,
        rule: Rule,
        n_values: int,
        status: Callable[[str], str | None] | None = None,
        early_interval_ms: int | None = EARLY_INTERVAL_MS,
        ttl_ms: int = STATE_TTL_MS,
        rules: Callable[[str], Rule | None] | None = None,
        columns: list[tuple[str, str | None]] | None = None,
    ):
        self.rule, self.n, self.status, self.early, self.ttl = rule, n_values, status, early_interval_ms, ttl_ms
        self.read_at, self.live, self.open = None, None, {}
        self.rules, self.first, self.present, self.known = rules, rule, rule, {}
        self.columns = columns or [source(a) for a in rule.aggregations]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.touched = handle.getValueState("touched", "at long")
        self.panes = handle.getMapState("panes", "pane long", "part string")
        self.fired = handle.getMapState("fired", "start long", "at long")
        self.last_early = handle.getValueState("last_early", "at long")
        if self.rules is not None:
            self.held = handle.getValueState("rule", "text string")
        self.math = Panes(self.rule)

    def look(self) -> Rule:
        """The rule as it is now. The file is read from the shared folder at most once a second."""
        clock = time.monotonic()
        if self.read_at is None or clock - self.read_at >= 1:
            self.read_at = clock
            now = self.rules(self.first.rule_id)
            if now is not None and now.active and now != self.present:
                self.check(now)
            self.present = now or self.present
        return self.present

    def check(self, now: Rule) -> None:
        """Raises if the plan that feeds this operator doesn't fit the rule."""

        def fed(r: Rule) -> tuple:
            w = r.windowing
            return r.topic, r.filters, r.keys, r.entity_field, w.stateless, w.event_time, w.use_kafka_timestamp, w.timestamp_field, w.timestamp_format

        if fed(now) != fed(self.first) or any(source(a)[0] != "none" and source(a) not in self.columns for a in now.aggregations):
            raise ValueError(f"rule {now.rule_id}: its topic, filters, keys, entity, kind of time or fields changed; start the stream again, on its checkpoint, with the present rule")

    def use(self, text: str) -> None:
        if text not in self.known:
            self.known[text] = Panes(restored(self.first, text))
        self.math = self.known[text]
        self.rule = self.math.rule

    def take(self, now: int) -> None:
        """Makes the present rule the group's snapshot."""
        text, held = snapshot(self.present), self.held.get()[0] if self.held.exists() else None
        if held != text:
            self.held.update((text,))
        before = restored(self.first, held) if held is not None else None
        self.use(text)
        if before is None or held == text:
            return
        w, stays = self.rule.windowing, {(a.alias, source(a)) for a in self.rule.aggregations}
        anew = {a.alias for a in before.aggregations if (a.alias, source(a)) not in stays}
        moves = (before.windowing.slide, before.windowing.offset) != (w.slide, w.offset)
        if not moves and not anew:
            return
        places: dict[int, list[dict]] = {}
        for at in sorted(k[0] for k in self.panes.keys()):
            pane = {k: v for k, v in json.loads(self.panes.getValue((at,))[0]).items() if k not in anew}
            places.setdefault(self.math.floor(at), []).append(pane)
        self.panes.clear()
        for at, panes in places.items():
            self.panes.updateValue((at,), (json.dumps(self.math.joined(panes)),))
            if moves:
                self.handle.registerTimer(at + w.slide if w.event_time else self.math.floor(now) + w.slide)
        fired = {self.math.floor(k[0]): self.fired.getValue(k) for k in list(self.fired.keys())}
        self.fired.clear()
        for at, when in fired.items():
            self.fired.updateValue((at,), when)

    def active(self) -> bool:
        """Whether the rule may emit now. The status file is read from the shared folder at most once a second."""
        if self.rules is not None:
            return self.look().active
        if self.status is None:
            return self.rule.active
        clock = time.monotonic()
        if self.read_at is None or clock - self.read_at >= 1:
            self.read_at, self.live = clock, self.status(self.rule.rule_id)
        return self.rule.active if self.live is None else self.live.upper() == "ACTIVE"

    def of(self, pane: int) -> dict | None:
        """A pane's partials: as this batch has them, else from the state."""
        if pane not in self.open:
            self.open[pane] = json.loads(self.panes.getValue((pane,))[0]) if self.panes.containsKey((pane,)) else None
        return self.open[pane]

    def window(self, end: int) -> tuple[int, list[dict]]:
        w = self.rule.windowing
        start = end - w.size_ms
        first = self.math.floor(start + w.slide - 1) if w.slide else start
        return start, [p for at in range(first, end, w.slide) if (p := self.of(at)) is not None]

    def row(self, kind: str, group: str, who: str, start: int, end: int, values: dict[str, float], breached: bool, final: bool) -> dict:
        return {"rule_id": self.rule.rule_id, "kind": kind, "group_key": group, "entity": who, "window_start_ms": start, "window_end_ms": end, "aggregates": json.dumps(values), "breached": breached, "is_final": final}

    def idle(self, clock: int) -> bool:
        """Whether the last event's pane ended (in processing time: the last event came) the TTL before ``clock``, and every window that holds it has closed.

        The store expires no event-time state by itself. The clock is that of the timers, one window after another, so none is skipped however far a
        batch moves the watermark.
        """
        w = self.rule.windowing
        last = self.touched.get()[0] if self.touched.exists() else None
        return last is not None and clock - last >= max(self.ttl, w.size_ms + w.slide + w.allowed_lateness_ms)

    def now(self, timers) -> int:
        return timers.getCurrentWatermarkInMs() if self.rule.windowing.event_time else timers.getCurrentProcessingTimeInMs()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        group, now, out = key[0], self.now(timerValues), []
        if self.rules is not None:
            if not self.look().active:
                return
            self.take(now)
        w = self.rule.windowing
        places = {s: k for k, s in enumerate(self.columns)}
        names = [f"v{places.get(source(a))}" for a in self.rule.aggregations]
        self.open, timers, touched = {}, set(), set()
        parts = list(rows)  # one group's events of one batch, in the order of ingestion whatever the Arrow chunks
        for part in [pd.concat(parts)] if parts else []:
            for r in part.sort_values(["ingest_ms", "offset"]).to_dict("records"):
                at = self.math.floor(int(r["ts_ms"]))
                pane = self.of(at)
                if pane is None:
                    pane = self.open[at] = {}
                self.math.add(pane, [None if v is None or v != v else v for v in (r.get(n) for n in names)])
                touched.add(at)
                end = at + w.slide
                timers.add(end if w.event_time else self.math.floor(now) + w.slide)
                if w.event_time and self.rule.sinks.agg and end <= now < end + w.allowed_lateness_ms:
                    start, panes = self.window(end)
                    values = self.math.merged(panes)
                    out.append(self.row("result", group, group, start, end, values, having.evaluate(self.rule.having, values), False))
                values = self.math.merged([pane])
                breached = having.evaluate(self.rule.having, values)
                if (self.rule.sinks.anomaly or self.rule.sinks.anomaly_store) and breached and not self.fired.containsKey((at,)):
                    self.fired.updateValue((at,), (now,))
                    who = r.get("entity")
                    out.append(self.row("anomaly", group, who if isinstance(who, str) else group, at, end, values, True, False))
                if self.early is not None and self.rule.sinks.agg:
                    clock_ms = timerValues.getCurrentProcessingTimeInMs()
                    before = self.last_early.get()[0] if self.last_early.exists() else None
                    if before is None or clock_ms - before >= self.early:
                        self.last_early.update((clock_ms,))
                        out.append(self.row("early", group, group, at, end, values, breached, False))
        for at in touched:
            self.panes.updateValue((at,), (json.dumps(self.open[at]),))
        self.open = {}
        for clock in timers:
            self.handle.registerTimer(clock)
        if touched:
            last = self.touched.get()[0] if self.touched.exists() else 0
            self.touched.update((max(last, max(touched) + w.slide) if w.event_time else now,))
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        group, end = key[0], expiredTimerInfo.getExpiryTimeInMs()
        if self.rules is not None and self.held.exists():
            self.use(self.held.get()[0])
        w = self.rule.windowing
        self.open = {}
        if self.idle(end if w.event_time else self.now(timerValues)):
            self.panes.clear()
            self.fired.clear()
            self.touched.clear()
            if self.rules is not None:
                self.held.clear()
            return
        if self.rules is not None and end != self.math.floor(end):  # of the grid before the rule changed
            return
        if not self.active():
            self.handle.registerTimer(end + w.slide)  # looked at again later, until the state is too old
            return
        start, panes = self.window(end)
        out = []
        if sum(p[ROWS] for p in panes):
            values = self.math.merged(panes)
            breached = having.evaluate(self.rule.having, values)
            if self.rule.sinks.agg:
                out.append(self.row("result", group, group, start, end, values, breached, True))
            if breached and (self.rule.sinks.anomaly or self.rule.sinks.anomaly_store) and not self.fired.containsKey((start,)):
                self.fired.updateValue((start,), (end,))
                out.append(self.row("anomaly", group, group, start, end, values, True, True))
        before = start - w.allowed_lateness_ms
        for at in [k[0] for k in self.panes.keys() if k[0] < before]:
            self.panes.removeKey((at,))
        for at in [k[0] for k in self.fired.keys() if k[0] < before]:
            self.fired.removeKey((at,))
        if any(True for _ in self.panes.keys()):
            self.handle.registerTimer(end + w.slide)
        if out:
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def status_file(path: str) -> Callable[[str], str | None]:
    """Statuses by rule id from a JSON file in a folder that all executors share (a mounted path, or a URL that pyarrow's file systems read).

    A rule that the file lacks is deleted; an unreadable file tells nothing.
    """

    def read(rule_id: str) -> str | None:
        from pyarrow import fs

        try:
            store, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
            with store.open_input_stream(at) as f:
                return str(json.loads(f.read()).get(rule_id, "DELETED"))
        except (OSError, ValueError):
            return None

    return read


def rules_file(path: str) -> Callable[[str], Rule | None]:
    """Rules by id from a JSON array of rules in a shared folder, as for ``status_file``: one that the file lacks is deleted, a file or rule that can't be read tells nothing."""

    def read(rule_id: str) -> Rule | None:
        from pyarrow import fs

        try:
            store, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
            with store.open_input_stream(at) as f:
                docs = [d for d in json.loads(f.read()) if str((d.get("rule_metadata") or {}).get("rule_id")) == rule_id]
            return of(docs[-1]) if docs else Rule(rule_id, status="DELETED")
        except (OSError, ValueError, TypeError, AttributeError, Rejected):
            return None

    return read


def evaluate_stream(
    events: DataFrame,
    rule: Rule,
    status: Callable[[str], str | None] | None = None,
    early_interval_ms: int | None = EARLY_INTERVAL_MS,
    watermark: str = WATERMARK,
    ttl_ms: int = STATE_TTL_MS,
    rules: Callable[[str], Rule | None] | None = None,
    fields: tuple[str, ...] = (),
) -> DataFrame:
    """Results and anomalies of one windowed rule over a stream in the canonical frame, as rows of OUTPUT told apart by ``kind``.

    Filters and fields are Columns; only the group key, the entity, the time and the aggregates' values reach the state operator (under names
    without a leading underscore, which it would replace by numbers). The watermark follows ingestion, as late event times are the rule's own matter.

    With ``rules``, windows, thresholds, sinks and aggregates may change while the stream runs; aggregates read the fields of ``rule`` in the ways it does, and
    ``fields`` in any way. Other changes need another plan, so the stream fails and says so; its checkpoint serves the next start.
    """
    later = [Aggregation(f"{f}{k}", function, f, high) for k, f in enumerate(fields) for function, high in (("SUM", False), ("COUNT_DISTINCT", False), ("COUNT_DISTINCT", True))]
    specs = (*rule.aggregations, *later)
    key, aggs = group_key(rule.keys), compile_all(specs)
    values = [(a.value if a.value is not None else F.lit(None).cast("double")).alias(f"v{k}") for k, a in enumerate(aggs)]
    rows = matching(events, rule).select(key.alias("group_key"), entity(rule.entity_field, key).alias("entity"), event_time(rule.windowing).alias("ts_ms"), "ingest_ms", "offset", F.timestamp_millis("ingest_ms").alias("ingest_ts"), *values)
    rows = rows.withWatermark("ingest_ts", watermark)
    mode = "eventTime" if rule.windowing.event_time else "processingTime"
    return rows.groupBy("group_key").transformWithStateInPandas(statefulProcessor=Evaluator(rule, len(aggs), status, early_interval_ms, ttl_ms, rules, [source(a) for a in specs]), outputStructType=OUTPUT, outputMode="Append", timeMode=mode)


def kinds(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two outputs of a batch of evaluated rows: results (early, late and final) and anomalies."""
    return batch.where("kind <> 'anomaly'"), batch.where("kind = 'anomaly'")


def stateless_stream(events: DataFrame, load_rules, write, checkpoint: str, interval: str = "60 seconds"):
    """Rules without window over a stream: each micro-batch compiles the rules of that moment, so that a change needs no restart."""
    from ..plans.batch import stateless_anomalies

    def each(batch: DataFrame, batch_id: int) -> None:
        for rule in load_rules().values():
            if rule.active and rule.windowing.stateless:
                write(stateless_anomalies(batch, rule), batch_id)

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def state_rows(query) -> int:
    """Keys that the query's state operators hold, from its last progress."""
    progress = query.lastProgress
    return sum(op["numRowsTotal"] for op in progress["stateOperators"]) if progress else 0
