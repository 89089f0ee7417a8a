"""Times: ISO and epoch parsing, India's local time, and window arithmetic. The session's time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.rules import IST_OFFSET_MS

ZONE = "Asia/Kolkata"
INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
LOCAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"


def iso_ms(text: Column) -> Column:
    """ISO-8601 to epoch milliseconds; a time without zone is India's. Anything else is null."""
    zoned = F.unix_millis(text.try_cast("timestamp"))
    local = F.unix_millis(F.concat(text, F.lit("Z")).try_cast("timestamp")) - IST_OFFSET_MS
    return F.when(text.rlike(INSTANT), zoned).when(text.rlike(LOCAL), local)


def epoch_ms(text: Column) -> Column:
    """A number, or a string that holds a whole one."""
    text = F.trim(text)
    return F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"))


def parse_ms(text: Column, form: str | None) -> Column:
    return iso_ms(text) if (form or "").upper() == "ISO_STRING" else epoch_ms(text)


def ist_string(ms: Column) -> Column:
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(ms), ZONE), "yyyy-MM-dd HH:mm:ss")


def ist_ms(text: Column) -> Column:
    """The reverse of ist_string; null for what it can't have made."""
    return F.unix_millis(F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), ZONE))


def floor_to_slide(ms: Column, slide: int, offset: int) -> Column:
    """The start of the pane that holds ms; whole-number arithmetic, right for times before the epoch too."""
    return ms - F.pmod(ms - F.lit(offset), F.lit(slide))
