"""Named queries over the test tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.fields import extract, group_key
from .functions.times import ist_ms, ist_string, iso_ms
from .operators.dedup import dedup_ttl
from .operators.filters import compile_filter, in_set
from .operators.routing import of_active, route, route_by_union
from .plans import batch
from .plans.rules import Rule, latest, of
from .sources.events import from_table
from .sources.sinks import penalties, retained, upsert_latest

DAY, HOUR = 86_400_000, 3_600_000

#: The fixture's events in SQL: what ``from_table`` makes of each row.
EV = """
    WITH ev AS (SELECT event_id, CAST(user_id AS VARCHAR) AS uid, event_type AS topic,
        CASE WHEN event_id % 17 = 0 THEN upper(event_type) ELSE event_type END AS kind,
        CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE value END AS num,
        event_id % 7 <> 0 AS has_value, (event_id % 7 <> 0 AND event_id % 11 = 0) AS is_na,
        CASE WHEN event_id % 13 = 0 THEN '' ELSE event_type END AS name, value AS amount,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        epoch_us(ts) // 1000 + (event_id % 5) * 1000 AS ingest_ms,
        CASE WHEN event_id % 19 = 0 THEN epoch_us(ts) // 1000 + (event_id % 5) * 1000 ELSE epoch_us(ts) // 1000 END AS event_ms
        FROM events)
"""


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's events. A table of fewer splits than cores is dealt to all of them, as its rows are made into JSON and parsed again."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    return from_table(events.repartition(cores, "event_id") if events.rdd.getNumPartitions() < cores else events)


def cond(field: str, operator: str, value=None, **more) -> dict:
    return {"type": "condition", "field": field, "operator": operator, "value": value} | more


def group(logic: str, *conditions: dict) -> dict:
    return {"type": "group", "logic": logic, "conditions": list(conditions)}


def rule(rule_id: str = "r", keys=("_data.user_id",), size: int = DAY, slide: int = 0, kind: str = "TUMBLING", filters=None, aggs=(("cnt", "COUNT", None),), having: str | None = None, **more) -> Rule:
    windowing = {"type": kind, "time_type": "EVENT_TIME", "size_ms": size, "slide_ms": slide} | more.pop("windowing", {})
    doc = {
        "rule_metadata": {"rule_id": rule_id, "status": more.pop("status", "ACTIVE"), "penalty_ttl_seconds": more.pop("ttl", 0)},
        "execution_routing": {"target_source_topic": more.pop("topic", "")},
        "filters": filters,
        "grouping": {"keys": list(keys), "entity_name": "user", "anomaly_entity_field": more.pop("entity_field", None)},
        "windowing": windowing,
        "aggregations": [{"alias": a, "function": f, "field": v} | dict(zip(("cardinality_hint", "capped"), h, strict=False)) for a, f, v, *h in aggs],
        "having_thresholds": {"expression": having},
    }
    return of(doc)


FILTERS: dict[str, tuple[dict | None, str]] = {
    "flt_and_group": (group("AND", cond("_data.value", "GREATER_THAN", 100), cond("event_type", "EQUALS", "click")), "coalesce(num > 100, FALSE) AND lower(kind) = 'click'"),
    "flt_or_group": (group("OR", cond("_data.value", "LESS_THAN", 20), group("AND", cond("event_type", "EQUALS", "error"), cond("_data.name", "NOT_EQUALS", ""))), "coalesce(num < 20, FALSE) OR (lower(kind) = 'error' AND name <> '')"),
    "flt_empty_group": (group("AND"), "TRUE"),
    "flt_null_node": (None, "TRUE"),
    "flt_unknown_node": ({"type": "other"}, "FALSE"),
    "flt_unknown_operator": (cond("event_type", "LIKES", "click"), "FALSE"),
    "flt_equals_text": (cond("event_type", "EQUALS", "ViEw"), "lower(kind) = 'view'"),
    "flt_equals_number": (cond("_data.user_id", "EQUALS", "7.0"), "uid = '7'"),
    "flt_not_equals": (cond("_data.value", "NOT_EQUALS", "n/a"), "NOT is_na"),
    "flt_not_equals_missing": (cond("_data.nothing", "NOT_EQUALS", "x"), "TRUE"),
    "flt_greater_than": (cond("_data.value", "GREATER_THAN", 250), "num > 250"),
    "flt_greater_than_equal": (cond("_data.value", "GREATER_THAN_EQUAL", "250.5"), "num >= 250.5"),
    "flt_less_than": (cond("_data.value", "LESS_THAN", 25), "num < 25"),
    "flt_less_than_equal": (cond("_data.value", "LESS_THAN_EQUAL", 25.5), "num <= 25.5"),
    "flt_compare_nan": (cond("_data.value", "LESS_THAN", "NaN"), "FALSE"),
    "flt_in": (cond("event_type", "IN", ["Purchase", "click"]), "lower(kind) IN ('purchase', 'click')"),
    "flt_in_no_number": (cond("_data.user_id", "IN", [7, "8.0"]), "uid = '7'"),
    "flt_regex_whole": (cond("event_type", "REGEX", "[a-z]+r"), "regexp_full_match(kind, '[a-z]+r')"),
    "flt_regex_bad": (cond("event_type", "REGEX", "(["), "FALSE"),
    "flt_contains": (cond("event_type", "CONTAINS", "UR"), "contains(lower(kind), 'ur')"),
    "flt_contains_empty": (cond("_data.value", "CONTAINS", ""), "has_value"),
    "flt_not_contains": (cond("_data.value", "NOT_CONTAINS", "N/"), "has_value AND NOT is_na"),
    "flt_starts_with": (cond("event_type", "STARTS_WITH", "SI"), "starts_with(lower(kind), 'si')"),
    "flt_ends_with": (cond("event_type", "ENDS_WITH", "CK"), "ends_with(lower(kind), 'ck')"),
    "flt_is_null": (cond("_data.value", "IS_NULL"), "NOT has_value"),
    "flt_is_not_null": (cond("_data.value", "IS_NOT_NULL"), "has_value"),
    "flt_date_before": (cond("_event_timestamp", "DATE_BEFORE", "2024-01-10T00:00:00Z", format="ISO_STRING"), "event_id % 19 <> 0 AND event_ms < 1704844800000"),
    "flt_date_after": (cond("_event_timestamp", "DATE_AFTER", "2024-01-10T05:30:00", format="ISO_STRING"), "event_id % 19 <> 0 AND event_ms > 1704844800000"),
    "flt_date_equals": (cond("_kafka_timestamp", "DATE_EQUALS", "1704067207179"), "ingest_ms = 1704067207179"),
    "flt_date_negative": (cond("_kafka_timestamp", "DATE_AFTER", "-5"), "FALSE"),
    "flt_in_named_set": (cond("_data.user_id", "IN_SET", "watched"), "uid IN ('3', '5', '8', '13', '21')"),
    "prj_dotted_name": (cond("a.b", "EQUALS", "dotted"), "TRUE"),
    "prj_nested_path": (cond("_data.props.k", "GREATER_THAN_EQUAL", 50), "k >= 50"),
    "prj_missing_parent": (cond("_data.none.k", "IS_NULL"), "TRUE"),
}
SETS = {"watched": frozenset({"3", "5", "8", "13", "21"})}


def filter_query(tree: dict | None) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: frame(spark, sf_dir).where(compile_filter(tree, SETS)).select(F.col("offset").alias("event_id"))


VALUE = "_data.value"
ALL_AGGS = (("cnt", "COUNT", None), ("total", "SUM", VALUE), ("mean", "AVG", VALUE), ("low", "MIN", VALUE), ("high", "MAX", VALUE), ("kinds", "COUNT_DISTINCT", "_data.name"), ("odd", "MEDIAN", VALUE))
ALL_SQL = """CAST(count(*) AS DOUBLE) AS cnt, round(coalesce(sum(num), 0), 7) AS total, round(coalesce(avg(num), 0), 7) AS mean, coalesce(min(num), 0) AS low, coalesce(max(num), 0) AS high,
    CAST(count(DISTINCT nullif(name, '')) AS DOUBLE) AS kinds, CAST(0 AS DOUBLE) AS odd"""


def shift(slide: int, align: int = 0) -> int:
    return (align - 19_800_000) % slide


def panes_sql(size: int, slide: int, align: int = 0, time: str = "event_ms", where: str = "TRUE", key: str = "uid") -> str:
    """Events with every window that holds them, in SQL."""
    off = shift(slide, align)
    return f"""{EV}, p AS (SELECT *, {key} AS group_key, CAST(floor(({time} - {off}) / {slide}.0) AS BIGINT) * {slide} + {off} AS pane FROM ev WHERE {where}),
        w AS (SELECT *, pane + i * {slide} - {size} AS window_start_ms, pane + i * {slide} AS window_end_ms FROM (SELECT *, unnest(range(1, {size // slide + 1})) AS i FROM p))"""


def windowed(r: Rule, rounded: tuple[str, ...] = ("total", "mean")) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = batch.results(frame(spark, sf_dir), r)
        return out.select(*[F.round(c, 7).alias(c) if c in rounded else c for c in out.columns if c not in ("entity_name", "is_final")])

    return run


def windowed_sql(aggs: str, having: str = "FALSE", rule_id: str = "r", **where) -> str:
    return f"""{panes_sql(**where)}, g AS (SELECT group_key, window_start_ms, window_end_ms, {aggs} FROM w GROUP BY ALL)
        SELECT '{rule_id}' AS rule_id, *, {having} AS breached FROM g"""


COUNT_SQL = "CAST(count(*) AS DOUBLE) AS cnt"
BIG = cond(VALUE, "GREATER_THAN", 10)
DAILY = rule("daily", filters=BIG, aggs=(("cnt", "COUNT", None), ("total", "SUM", VALUE)), having="cnt >= 3 && total > 50")
HAVINGS: dict[str, tuple[str, str]] = {
    "having_and_or": ("cnt >= 3 && (total > 900 || mean < 100)", "cnt >= 3 AND (total > 900 OR mean < 100)"),
    "having_arithmetic": ("total / cnt * 2 - low > high + 1", "total / cnt * 2 - low > high + 1"),
    "having_words": ("cnt ge 3 and not (mean lt 200) or kinds eq 1", "(cnt >= 3 AND NOT mean < 200) OR kinds = 1"),
    "having_modulo": ("cnt % 2 == 1", "cnt % 2 = 1"),
    "having_ternary": ("cnt > 2 ? total > 700 : high > 400", "CASE WHEN cnt > 2 THEN total > 700 ELSE high > 400 END"),
    "having_unary_minus": ("-low < -100", "-low < -100"),
    "having_unknown_name": ("nothing > 1", "FALSE"),
    "having_unknown_is_null": ("nothing == null", "TRUE"),
    "having_null_as_zero": ("nothing + cnt > 2", "cnt > 2"),
    "having_by_zero": ("cnt / odd == 0", "TRUE"),
    "having_not_boolean": ("cnt + 1", "FALSE"),
    "having_bad": ("cnt > ", "FALSE"),
    "having_blank": ("  ", "FALSE"),
}

SPECS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        SPECS[name] = (f, sql)
        return f

    return put


for _name, (_tree, _sql) in FILTERS.items():
    SPECS[_name] = (filter_query(_tree), f"{EV} SELECT event_id FROM ev WHERE coalesce({_sql}, FALSE)")
for _name, (_text, _sql) in HAVINGS.items():
    _r = rule(aggs=ALL_AGGS, having=_text)
    # Compares the exact values, then rounds, in both.
    SPECS[_name] = (windowed(_r), f"""{panes_sql(size=DAY, slide=DAY)}, g AS (SELECT group_key, window_start_ms, window_end_ms, CAST(count(*) AS DOUBLE) AS cnt, coalesce(sum(num), 0) AS total, coalesce(avg(num), 0) AS mean,
        coalesce(min(num), 0) AS low, coalesce(max(num), 0) AS high, CAST(count(DISTINCT nullif(name, '')) AS DOUBLE) AS kinds, CAST(0 AS DOUBLE) AS odd FROM w GROUP BY ALL)
        SELECT 'r' AS rule_id, group_key, window_start_ms, window_end_ms, cnt, round(total, 7) AS total, round(mean, 7) AS mean, low, high, kinds, odd, {_sql} AS breached FROM g""")
for _alias, _function, _field, _sql in (
    ("cnt", "COUNT", None, "CAST(count(*) AS DOUBLE)"),
    ("total", "SUM", VALUE, "round(coalesce(sum(num), 0), 7)"),
    ("mean", "AVG", VALUE, "round(coalesce(avg(num), 0), 7)"),
    ("low", "MIN", VALUE, "coalesce(min(num), 0)"),
    ("high", "MAX", VALUE, "coalesce(max(num), 0)"),
    ("kinds", "COUNT_DISTINCT", "_data.name", "CAST(least(count(DISTINCT nullif(name, '')), 50000) AS DOUBLE)"),
    ("odd", "MEDIAN", VALUE, "CAST(0 AS DOUBLE)"),
):
    SPECS[f"agg_{_function.lower()}"] = (windowed(rule(aggs=((_alias, _function, _field),))), windowed_sql(f"{_sql} AS {_alias}", size=DAY, slide=DAY))
    SPECS[f"agg_{_function.lower()}_sliding"] = (windowed(rule(aggs=((_alias, _function, _field),), kind="SLIDING", slide=6 * HOUR, keys=("event_type",))), windowed_sql(f"{_sql} AS {_alias}", size=DAY, slide=6 * HOUR, key="kind"))

SPECS |= {
    "entry_daily_spend": (windowed(DAILY), windowed_sql("CAST(count(*) AS DOUBLE) AS cnt, round(coalesce(sum(num), 0), 7) AS total", "cnt >= 3 AND total > 50", "daily", size=DAY, slide=DAY, where="num > 10")),
    "agg_all_in_one": (windowed(rule(aggs=ALL_AGGS, keys=("event_type", VALUE[:5] + ".user_id"))), windowed_sql(ALL_SQL, size=DAY, slide=DAY, key="kind || '|' || uid")),
    "agg_global": (windowed(rule(keys=("__GLOBAL__",), aggs=ALL_AGGS)), windowed_sql(ALL_SQL, size=DAY, slide=DAY, key="'__GLOBAL__'")),
    "prj_group_key_missing": (windowed(rule(keys=("event_type", "_data.nothing"))), windowed_sql(COUNT_SQL, size=DAY, slide=DAY, key="kind || '|NULL'")),
    "win_tumbling": (windowed(rule(size=6 * HOUR)), windowed_sql(COUNT_SQL, size=6 * HOUR, slide=6 * HOUR)),
    "win_ist_aligned": (windowed(rule(windowing={"alignment_offset_ms": 2 * HOUR})), windowed_sql(COUNT_SQL, size=DAY, slide=DAY, align=2 * HOUR)),
    "win_sliding": (windowed(rule(kind="SLIDING", slide=6 * HOUR, aggs=ALL_AGGS)), windowed_sql(ALL_SQL, size=DAY, slide=6 * HOUR)),
    "win_sliding_nondivisible": (windowed(rule(kind="SLIDING", size=10 * HOUR, slide=4 * HOUR, keys=("event_type",), aggs=ALL_AGGS)), windowed_sql(ALL_SQL, size=10 * HOUR, slide=4 * HOUR, key="kind")),
    "win_slide_gt_size": (windowed(rule(kind="SLIDING", size=HOUR, slide=2 * HOUR)), windowed_sql(COUNT_SQL, size=HOUR, slide=2 * HOUR)),
    "win_ingest_time": (windowed(rule(windowing={"use_kafka_timestamp": True})), windowed_sql(COUNT_SQL, size=DAY, slide=DAY, time="ingest_ms")),
    "win_ts_fallback": (windowed(rule(windowing={"timestamp_field": "_event_timestamp", "timestamp_format": "ISO_STRING"})), windowed_sql(COUNT_SQL, size=DAY, slide=DAY)),
    "win_ts_bad_field": (windowed(rule(windowing={"timestamp_field": "event_type"})), windowed_sql(COUNT_SQL, size=DAY, slide=DAY)),
    "rule_inactive": (windowed(rule(status="PAUSED")), windowed_sql(COUNT_SQL, size=DAY, slide=DAY, where="FALSE")),
    "rules_routing_topic": (windowed(rule(topic="CLICK")), windowed_sql(COUNT_SQL, size=DAY, slide=DAY, where="topic = 'click'")),
}


@query("win_none_stateless", f"{EV} SELECT 'n' AS rule_id, uid AS entity, event_id AS offset, event_ms, 60 AS penalty_ttl_seconds FROM ev WHERE num > 10 AND amount > 100 AND kind = 'purchase'")
def _(spark, sf_dir):
    r = rule("n", kind="NONE", filters=group("AND", BIG, cond("event_type", "EQUALS", "purchase")), having="amount > 100 && event_type == 'purchase'", entity_field="_data.user_id", ttl=60)
    return batch.stateless_anomalies(frame(spark, sf_dir), r)


#: Stateless thresholds on fields of every JSON type: (expression, SQL over the fixture's events).
STATELESS = {
    "none_number_number": ("amount_n > k_n * 5", "amount > k * 5"),
    "none_number_text": ("amount == amount_n", "amount IS NOT NULL"),
    "none_text_order": ("event_type < 'p'", "kind < 'p'"),
    "none_boolean": ("flag == true && flag", "event_id % 2 = 0"),
    "none_boolean_alone": ("flag", "event_id % 2 = 0"),
    "none_null": ("gone == null && amount_n != null", "TRUE"),
    "none_order_of_null": ("gone < 5 || gone >= 0", "FALSE"),
    "none_text_is_no_number": ("event_type > 1 || event_type != 1", "FALSE"),
    "none_text_tests": ("event_type =^ 'p' || event_type =$ 'k' || event_type =~ '[A-Z]+'", "starts_with(kind, 'p') OR ends_with(kind, 'k') OR regexp_full_match(kind, '[A-Z]+')"),
    "none_empty_elvis": ("empty(gone) && size(event_type) > 5 && (gone ?? k_n) > 20 && (flag ?: true)", "length(kind) > 5 AND k > 20"),
    "none_payload_is_text": ("_data.k > 0", "FALSE"),
}


def stateless(text: str) -> Callable[[SparkSession, str], DataFrame]:
    """A rule without window over events with numbers, booleans and nulls at the top, which the other queries' events lack."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        k = F.get_json_object("data", "$.props.k").cast("long")
        more = F.to_json(F.struct(F.get_json_object("raw", "$.amount").cast("double").alias("amount_n"), k.alias("k_n"), (F.col("offset") % 2 == 0).alias("flag")))
        raw = F.concat(F.substring(more, F.lit(1), F.length(more) - 1), F.lit(',"gone":null,'), F.substring("raw", 2, 1 << 30))
        out = batch.stateless_anomalies(frame(spark, sf_dir).withColumn("raw", raw), rule("n", kind="NONE", keys=("event_type",), having=text))
        return out.select(F.col("offset").alias("event_id"), "entity")

    return run


for _name, (_text, _sql) in STATELESS.items():
    SPECS[_name] = (stateless(_text), f"{EV} SELECT event_id, kind AS entity FROM ev WHERE coalesce({_sql}, FALSE)")


@query("agg_hll", windowed_sql("TRUE AS close", size=30 * DAY, slide=30 * DAY, key="kind").replace("FALSE AS breached", "TRUE AS ok"))
def _(spark, sf_dir):
    spec = (("approx", "COUNT_DISTINCT", "_data.user_id", "HIGH"), ("exact", "COUNT_DISTINCT", "_data.user_id", "LOW", False))
    out = batch.results(frame(spark, sf_dir), rule(keys=("event_type",), size=30 * DAY, aggs=spec))
    close = F.abs(F.col("approx") - F.col("exact")) <= 0.05 * F.col("exact")
    return out.select("rule_id", "group_key", "window_start_ms", "window_end_ms", close.alias("close"), F.lit(True).alias("ok"))


@query("agg_hll_sliding", windowed_sql("TRUE AS close", size=DAY, slide=6 * HOUR, key="kind").replace("FALSE AS breached", "TRUE AS ok"))
def _(spark, sf_dir):
    spec = (("approx", "COUNT_DISTINCT", "_data.user_id", "HIGH"), ("exact", "COUNT_DISTINCT", "_data.user_id", "LOW", False))
    out = batch.results(frame(spark, sf_dir), rule(keys=("event_type",), kind="SLIDING", slide=6 * HOUR, aggs=spec))
    close = F.abs(F.col("approx") - F.col("exact")) <= 0.05 * F.col("exact")
    return out.select("rule_id", "group_key", "window_start_ms", "window_end_ms", close.alias("close"), F.lit(True).alias("ok"))


@query("prj_group_key", f"{EV} SELECT event_id, kind || '|' || coalesce(CASE WHEN is_na THEN 'n/a' END, 'NULL') || '|NULL' AS group_key, '__GLOBAL__' AS all_key FROM ev WHERE num IS NULL")
def _(spark, sf_dir):
    rows = frame(spark, sf_dir).where(F.coalesce(extract(VALUE), F.lit("n/a")) == "n/a")
    return rows.select(F.col("offset").alias("event_id"), group_key(["event_type", VALUE, "nothing"]).alias("group_key"), group_key(["__GLOBAL__"]).alias("all_key"))


@query("src_envelope", f"{EV} SELECT event_id, topic AS source_topic, ingest_ms, event_ms FROM ev")
def _(spark, sf_dir):
    return frame(spark, sf_dir).select(F.col("offset").alias("event_id"), "source_topic", "ingest_ms", "event_ms")


@query("src_malformed_dropped", "SELECT event_id FROM events WHERE event_id % 5 = 4")
def _(spark, sf_dir):
    from .sources.events import decode

    i = F.col("event_id") % 5
    value = F.when(i == 0, None).when(i == 1, "").when(i == 2, "{bad").when(i == 3, "[1]").otherwise('{"_data": "{\\"x\\": 1}"}')
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(value.alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.lit(5).alias("timestamp"))
    return decode(rows).where(extract("_data.x") == "1").select(F.col("offset").alias("event_id"))


ROUTES = [rule("a", filters=BIG, topic="click"), rule("b", keys=("event_type",), filters=cond("_data.name", "EQUALS", "")), rule("c", status="PAUSED"), rule("d", filters=cond("_data.user_id", "IN", ["1", "2"]), entity_field="_data.code")]
ROUTES_SQL = f"""{EV} SELECT event_id, 'a' AS rule_id, uid AS group_key, uid AS entity FROM ev WHERE topic = 'click' AND num > 10
    UNION ALL SELECT event_id, 'b', kind, kind FROM ev WHERE name = '' UNION ALL SELECT event_id, 'd', uid, uid || '-' || topic FROM ev WHERE uid IN ('1', '2')"""


@query("rules_routing", ROUTES_SQL)
def _(spark, sf_dir):
    return route(frame(spark, sf_dir), ROUTES).select(F.col("offset").alias("event_id"), "rule_id", "group_key", "entity")


@query("multi_rule_union", ROUTES_SQL)
def _(spark, sf_dir):
    return route_by_union(frame(spark, sf_dir), ROUTES).select(F.col("offset").alias("event_id"), "rule_id", "group_key", "entity")


@query("multi_rule_results", f"""SELECT rule_id, group_key, window_start_ms, window_end_ms, cnt, breached FROM ({windowed_sql(COUNT_SQL, "cnt > 2", "a", size=DAY, slide=DAY, where="num > 10")})
    UNION ALL SELECT rule_id, group_key, window_start_ms, window_end_ms, cnt, breached FROM ({windowed_sql(COUNT_SQL, "FALSE", "b", size=DAY, slide=6 * HOUR, key="kind")})""")
def _(spark, sf_dir):
    rules = [rule("a", filters=BIG, having="cnt > 2"), rule("b", keys=("event_type",), kind="SLIDING", slide=6 * HOUR)]
    return batch.evaluate(frame(spark, sf_dir), rules).select("rule_id", "group_key", "window_start_ms", "window_end_ms", F.col("aggregates")["cnt"].alias("cnt"), "breached")


UPDATES = "SELECT 'r' || CAST(event_id % 40 AS VARCHAR) AS rule_id, CASE event_type WHEN 'error' THEN 'DELETED' WHEN 'view' THEN 'PAUSED' ELSE 'ACTIVE' END AS status, event_id AS \"offset\" FROM events"


def updates(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    status = F.when(F.col("event_type") == "error", "DELETED").when(F.col("event_type") == "view", "PAUSED").otherwise("ACTIVE")
    return rows.select(F.concat(F.lit("r"), (F.col("event_id") % 40).cast("string")).alias("rule_id"), status.alias("status"), F.col("event_id").alias("offset"))


LATEST = f"WITH u AS ({UPDATES}), l AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY \"offset\" DESC) AS n FROM u) SELECT rule_id, status, \"offset\" FROM l WHERE n = 1 AND status <> 'DELETED'"
query("rules_latest", LATEST)(lambda spark, sf_dir: latest(updates(spark, sf_dir)))


@query("rule_status_semi", f"SELECT event_id, 'r' || CAST(event_id % 50 AS VARCHAR) AS rule_id FROM events WHERE 'r' || CAST(event_id % 50 AS VARCHAR) IN (SELECT rule_id FROM ({LATEST}) WHERE status = 'ACTIVE')")
def _(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.concat(F.lit("r"), (F.col("event_id") % 50).cast("string")).alias("rule_id"))
    return of_active(rows, latest(updates(spark, sf_dir))).select("event_id", "rule_id")


@query("flt_in_large_set", f"{EV} SELECT event_id FROM ev WHERE uid IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 5000)")
def _(spark, sf_dir):
    members = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_acctbal > 5000").select(F.col("c_custkey").cast("string").alias("k"))
    return in_set(frame(spark, sf_dir), "_data.user_id", members, "k").select(F.col("offset").alias("event_id"))


@query("dedup_ttl_gap", f"{EV}, g AS (SELECT event_id, ingest_ms - lag(ingest_ms) OVER (PARTITION BY uid, topic ORDER BY ingest_ms, event_id) AS gap FROM ev) SELECT event_id FROM g WHERE gap IS NULL OR gap >= 900000")
def _(spark, sf_dir):
    return dedup_ttl(frame(spark, sf_dir), extract("_data.code"), 900_000).select(F.col("offset").alias("event_id"))


@query("dedup_empty_key", f"{EV}, g AS (SELECT event_id, ingest_ms - lag(ingest_ms) OVER (PARTITION BY name ORDER BY ingest_ms, event_id) AS gap FROM ev WHERE name <> '') SELECT event_id FROM g WHERE gap IS NULL OR gap >= 60000")
def _(spark, sf_dir):
    return dedup_ttl(frame(spark, sf_dir), extract("_data.name"), 60_000).select(F.col("offset").alias("event_id"))


EARLY = rule("e", keys=("event_type",), size=6 * HOUR, aggs=(("cnt", "COUNT", None), ("total", "SUM", VALUE), ("users", "COUNT_DISTINCT", "_data.user_id")), having="cnt >= 5 && users > 3 && total > 200", entity_field="_data.user_id", ttl=30)
EARLY_SLIDING = rule("e", keys=("event_type",), size=12 * HOUR, slide=6 * HOUR, kind="SLIDING", aggs=(("cnt", "COUNT", None),), having="cnt >= 14", entity_field="_data.user_id")


def early_sql(size: int, slide: int, running: str, having: str) -> str:
    """First breaching event per pane; running counts of distinct users by their first appearances."""
    return f"""{panes_sql(size, slide, key="kind")},
        f AS (SELECT *, row_number() OVER (PARTITION BY group_key, pane, uid ORDER BY ingest_ms, event_id) = 1 AS fresh FROM p),
        r AS (SELECT *, {running} FROM f WINDOW o AS (PARTITION BY group_key, pane ORDER BY ingest_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        e AS (SELECT *, row_number() OVER (PARTITION BY group_key, pane ORDER BY ingest_ms, event_id) AS n FROM r WHERE {having})"""


EARLY_RUN = "count(*) OVER o AS cnt, coalesce(sum(num) OVER o, 0) AS total, count(*) FILTER (WHERE fresh) OVER o AS users"
EARLY_HAVING = "cnt >= 5 AND users > 3 AND total > 200"


@query("early_fire_first_breach", f"{early_sql(6 * HOUR, 6 * HOUR, EARLY_RUN, EARLY_HAVING)} SELECT 'e' AS rule_id, group_key, pane, uid AS entity, event_id AS \"offset\", ingest_ms FROM e WHERE n = 1")
def _(spark, sf_dir):
    return batch.early_fires(frame(spark, sf_dir), EARLY)


def once_sql(size: int, slide: int, running: str, early: str, final: str, ttl: int, aggs: str) -> str:
    return f"""{early_sql(size, slide, running, early)},
        x AS (SELECT group_key, pane AS start_ms, uid AS entity, TRUE AS early FROM e WHERE n = 1),
        y AS (SELECT group_key, window_start_ms AS start_ms FROM (SELECT group_key, window_start_ms, {aggs} FROM w GROUP BY ALL) WHERE {final})
        SELECT 'e' AS rule_id, group_key, start_ms, coalesce(x.entity, group_key) AS entity, coalesce(early, FALSE) AS early, {ttl} AS penalty_ttl_seconds FROM x FULL JOIN y USING (group_key, start_ms)"""


FINAL_AGGS = "count(*) AS cnt, coalesce(sum(num), 0) AS total, count(DISTINCT uid) AS users"


@query("anomaly_once_per_window", once_sql(6 * HOUR, 6 * HOUR, EARLY_RUN, EARLY_HAVING, EARLY_HAVING, 30, FINAL_AGGS))
def _(spark, sf_dir):
    return batch.anomalies(frame(spark, sf_dir), EARLY)


@query("anomaly_once_sliding", once_sql(12 * HOUR, 6 * HOUR, EARLY_RUN, "cnt >= 14", "cnt >= 14", 0, FINAL_AGGS))
def _(spark, sf_dir):
    return batch.anomalies(frame(spark, sf_dir), EARLY_SLIDING)


@query("sink_upsert_latest", f"{EV}, l AS (SELECT *, row_number() OVER (PARTITION BY kind, uid ORDER BY ingest_ms DESC, event_id DESC) AS n FROM ev) SELECT kind AS \"ruleId\", uid AS \"groupKey\", ingest_ms AS \"producedAt\", event_id FROM l WHERE n = 1")
def _(spark, sf_dir):
    rows = frame(spark, sf_dir).select(extract("event_type").alias("ruleId"), extract("_data.user_id").alias("groupKey"), F.col("ingest_ms").alias("producedAt"), F.col("offset").alias("event_id"))
    return upsert_latest(rows, ("ruleId", "groupKey"), "producedAt", ("event_id",))


AT = 1705276800000


@query("penalty_active", f"""{EV}, m AS (SELECT kind AS rule_id, uid AS entity, max(ingest_ms) AS produced_ms FROM ev WHERE ingest_ms <= {AT} GROUP BY ALL),
    t AS (SELECT m.*, max((e.event_id % 4 - 1) * 7200) AS ttl FROM m JOIN ev e ON e.kind = m.rule_id AND e.uid = m.entity AND e.ingest_ms = m.produced_ms GROUP BY ALL),
    x AS (SELECT rule_id, entity, produced_ms, CASE WHEN ttl = 0 THEN produced_ms + 3600000 WHEN ttl > 0 THEN produced_ms + ttl * 1000 END AS expires_ms FROM t)
    SELECT * FROM x WHERE expires_ms IS NULL OR expires_ms > {AT}""")
def _(spark, sf_dir):
    rows = frame(spark, sf_dir).where(F.col("ingest_ms") <= AT).select(extract("event_type").alias("rule_id"), extract("_data.user_id").alias("entity"), F.col("ingest_ms").alias("produced_ms"), ((F.col("offset") % 4 - 1) * 7200).alias("penalty_ttl_seconds"))
    return penalties(rows, AT)


@query("sink_retention", "SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-21'")
def _(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("day", F.to_date("ts"))
    return retained(rows, "day", 9, "2024-01-30").select("event_id")


@query("sink_result_rows", f"""{windowed_sql(COUNT_SQL, "cnt > 2", size=DAY, slide=DAY)}""".replace("SELECT 'r' AS rule_id, *, cnt > 2 AS breached FROM g", """SELECT 'r' AS id, 'user' AS "entityName", group_key AS "groupKey", group_key AS "entityValue", cnt > 2 AS "thresholdBreached", TRUE AS "isFinal",
    strftime(make_timestamp((window_start_ms + 19800000) * 1000), '%Y-%m-%d %H:%M:%S') AS "windowStart", strftime(make_timestamp((window_end_ms + 19800000) * 1000), '%Y-%m-%d %H:%M:%S') AS "windowEnd", '{"cnt":' || CAST(cnt AS VARCHAR) || '}' AS "aggResult" FROM g"""))
def _(spark, sf_dir):
    return batch.result_rows(batch.results(frame(spark, sf_dir), rule(having="cnt > 2")), ["cnt"]).drop("producedAt")


@query("fn_ist_format", f"{EV} SELECT event_id, strftime(make_timestamp((event_ms + 19800000) * 1000), '%Y-%m-%d %H:%M:%S') AS ist, (event_ms // 1000) * 1000 AS back FROM ev")
def _(spark, sf_dir):
    ist = ist_string(F.col("event_ms"))
    return frame(spark, sf_dir).select(F.col("offset").alias("event_id"), ist.alias("ist"), ist_ms(ist).alias("back"))


@query("fn_iso_parse", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch_us(ts) // 1000 WHEN 1 THEN epoch_us(ts) // 1000 - 19800000 WHEN 2 THEN epoch_us(ts) // 1000 - 7200000 END AS ms FROM events""")
def _(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("t", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    i = F.col("event_id") % 5
    text = F.when(i == 0, F.concat("t", F.lit("Z"))).when(i == 1, F.col("t")).when(i == 2, F.concat("t", F.lit("+02:00"))).when(i == 3, F.substring("t", 1, 10)).otherwise("no time")
    return rows.select("event_id", iso_ms(text).alias("ms"))


@query("fn_json_agg", """SELECT event_id, '{"cnt":' || CAST(CAST(event_id AS DOUBLE) AS VARCHAR) || '}' AS j FROM events""")
def _(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.select("event_id", F.to_json(F.create_map(F.lit("cnt"), F.col("event_id").cast("double"))).alias("j"))


@cache
def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from .streaming.queries import queries as streams

    return {k: f for k, (f, _) in SPECS.items()} | streams()


def oracle_sql() -> dict[str, str]:
    from .streaming.queries import oracle_sql as streams

    return {k: sql for k, (_, sql) in SPECS.items() if sql} | streams()


