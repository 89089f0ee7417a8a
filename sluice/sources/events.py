"""Sources: events of any origin as the canonical frame, and rules.

The frame: raw, data STRING; source_topic STRING; partition INT; offset, ingest_ms, event_ms BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import json_at
from ..functions.times import epoch_ms, iso_ms
from ..plans.rules import Rule, accepted, registry

TIME_FIELD = "_event_timestamp"


def is_object(raw: Column) -> Column:
    """Whether a string is one JSON object: what can't be parsed, is empty or is of another kind is no event."""
    return F.coalesce(raw.rlike(r"^\s*\{") & F.try_parse_json(raw).isNotNull(), F.lit(False))


def decode(records: DataFrame, time_format: str = "ISO_STRING") -> DataFrame:
    """The canonical frame of raw records (value STRING, topic STRING, partition INT, offset BIGINT, timestamp in ms BIGINT).

    Null, empty and malformed records go. The payload may be an object or a string that holds one. An event time that is missing or
    unreadable is the ingestion time.
    """
    raw, text = F.col("value").cast("string"), json_at("value", [TIME_FIELD])
    when = iso_ms(text) if time_format.upper() == "ISO_STRING" else epoch_ms(text)
    return records.where(is_object(raw)).select(
        raw.alias("raw"),
        json_at("value", ["_data"]).alias("data"),
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.col("timestamp").cast("long").alias("ingest_ms"),
        F.coalesce(when, F.col("timestamp").cast("long")).alias("event_ms"),
    )


def kafka_events(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The frame over a Kafka topic, as a stream from the committed offsets or else the latest; needs Spark's Kafka connector."""
    read = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "latest")
    for k, v in options.items():
        read = read.option(k, v)
    return decode(read.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", F.unix_millis("timestamp").alias("timestamp")))


def file_events(spark: SparkSession, path: str, streaming: bool = False, topic: str = "events", **options: str) -> DataFrame:
    """The frame over text files with a JSON event per line; the offset is a row number within the read, ingestion the file's time."""
    read = spark.readStream if streaming else spark.read
    lines = read.options(**options).text(path)
    return decode(lines.select("value", F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.unix_millis("_metadata.file_modification_time").alias("timestamp")))


def rules_from(spark: SparkSession, path: str) -> dict[str, Rule]:
    """The registry from text files with a rule per line, in the order of names and lines; rejected lines are left out."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n")).orderBy("f", "b", "n")
    return registry(accepted([r["value"] for r in rows.toLocalIterator()])[0])


def from_table(events: DataFrame) -> DataFrame:
    """The frame over the table ``events``, with deterministic faults by event_id.

    % 7 = 0: no value; % 11 = 0: value "n/a"; % 13 = 0: an empty name; % 17 = 0: the type in upper case; % 19 = 0: an unreadable time.
    Ingestion is (event_id % 5) seconds after the event.
    """
    i = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    value = F.when(i % 7 == 0, None).when(i % 11 == 0, "n/a").otherwise(F.col("value").cast("string"))
    data = F.struct(
        F.concat(F.lit("e-"), i.cast("string")).alias("authCode"),
        F.col("user_id").cast("string").alias("user_id"),
        value.alias("value"),
        F.when(i % 13 == 0, "").otherwise(F.col("event_type")).alias("name"),
        F.concat_ws("-", "user_id", "event_type").alias("code"),
        F.from_json("props", "k long").alias("props"),
    )
    stamp = F.when(i % 19 == 0, "not a time").otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    kind = F.when(i % 17 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    raw = F.to_json(F.struct(stamp.alias(TIME_FIELD), kind.alias("event_type"), F.col("value").cast("string").alias("amount"), F.lit("dotted").alias("a.b"), data.alias("_data")))
    ingest = F.unix_millis(ts) + (i % 5) * 1000
    return decode(events.select(raw.alias("value"), F.col("event_type").alias("topic"), F.lit(0).alias("partition"), i.alias("offset"), ingest.alias("timestamp")))
