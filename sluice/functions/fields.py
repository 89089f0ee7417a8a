"""Field access and group keys over the canonical frame of events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.rules import GLOBAL

#: What ingestion adds to an event, and the frame's column for it.
ENVELOPE = {"_source_topic": "source_topic", "_kafka_partition": "partition", "_kafka_offset": "offset", "_kafka_timestamp": "ingest_ms", "_event_timestamp_epoch_ms": "event_ms"}


def json_at(column: str, names: list[str]) -> Column:
    if any("'" in n for n in names):
        return F.lit(None).cast("string")
    return F.get_json_object(F.col(column), "$" + "".join(f"['{n}']" for n in names))


def extract(path: str | None) -> Column:
    """A field as a string, null if it is missing or null: ``_data.a.b`` goes down the payload, anything else is one top-level name, dots included."""
    if path is None or not path.strip():
        return F.lit(None).cast("string")
    if path.startswith("_data."):
        return json_at("data", path.removeprefix("_data.").split("."))
    if path in ENVELOPE:
        return F.col(ENVELOPE[path]).cast("string")
    return F.col("data") if path == "_data" else json_at("raw", [path])


def number(column: Column) -> Column:
    """A string as a double; null where it is none."""
    return column.try_cast("double")


def group_key(keys: tuple[str, ...] | list[str] | None) -> Column:
    """Key values joined by |, missing ones as NULL; the global key for none or for the global one alone."""
    if not keys or list(keys) == [GLOBAL]:
        return F.lit(GLOBAL)
    return F.concat_ws("|", *[F.coalesce(extract(k), F.lit("NULL")) for k in keys])


def entity(path: str | None, key: Column) -> Column:
    """An anomaly's entity: the field if the rule names one and the event has it, else the group key."""
    return F.coalesce(extract(path), key) if path else key
