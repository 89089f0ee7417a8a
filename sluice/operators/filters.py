"""Filter trees, compiled to one boolean Column that is never null."""

from __future__ import annotations

import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import extract, number
from ..functions.times import parse_ms

NUMBER = re.compile(r"\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[+-]?Infinity|NaN)[dDfF]?\s*")


def as_double(text: str) -> float | None:
    """What a condition's value is as a number, by the rules for the events' strings."""
    m = NUMBER.fullmatch(text)
    return float(m[1].replace("Infinity", "inf").replace("NaN", "nan")) if m else None


def as_text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, list):
        return "[" + ", ".join(map(as_text, value)) + "]"
    return str(value)


def valid_pattern(pattern: str) -> bool:
    spark = SparkSession.getActiveSession()
    try:
        spark._jvm.java.util.regex.Pattern.compile(pattern) if spark else re.compile(pattern)
    except Exception:
        return False
    return True


#: Operators that test one field against a set that the caller supplies under the operator's name, whatever the condition's field and value.
SET_OPERATORS = {"IS_FINANCIAL_AUA": "_data.aua"}


def leaf(node: dict[str, Any], sets: dict[str, frozenset[str]] | None = None) -> Column:
    """One condition. A missing field satisfies IS_NULL and NOT_EQUALS only; unknown operators, bad values and sets that aren't supplied satisfy nothing."""
    op = str(node.get("operator") or "").strip().upper()
    no = F.lit(False)
    if op in SET_OPERATORS:
        node, op = {"field": SET_OPERATORS[op], "value": op}, "IN_SET"
    if op == "IN_SET":  # membership in a set that the caller supplies by name
        members = (sets or {}).get(node.get("value"))
        return F.coalesce(extract(node.get("field")).isin(sorted(members)), no) if members else no
    value, field = node.get("value"), extract(node.get("field"))
    if op == "IS_NULL":
        return field.isNull()
    if op == "IS_NOT_NULL":
        return field.isNotNull()
    if op in ("DATE_BEFORE", "DATE_AFTER", "DATE_EQUALS"):
        a, b = parse_ms(field, node.get("format")), parse_ms(F.lit(as_text(value)), node.get("format"))
        test = {"DATE_BEFORE": a < b, "DATE_AFTER": a > b, "DATE_EQUALS": a == b}[op]
        return F.coalesce((a >= 0) & (b >= 0) & test, no)
    text = as_text(value)
    low, lit_low, x, y = F.lower(field), text.lower(), number(field), as_double(text)
    real = x.isNotNull() & ~F.isnan(x)
    if op == "EQUALS":
        same = low == lit_low
        return F.coalesce(same if y is None or y != y else same | (real & (x == y)), no)
    if op == "NOT_EQUALS":
        same = low == lit_low
        return F.coalesce(~(same if y is None or y != y else same | (real & (x == y))), F.lit(True))
    if op in ("GREATER_THAN", "GREATER_THAN_EQUAL", "LESS_THAN", "LESS_THAN_EQUAL"):
        if y is None or y != y:
            return no
        test = {"GREATER_THAN": x > y, "GREATER_THAN_EQUAL": x >= y, "LESS_THAN": x < y, "LESS_THAN_EQUAL": x <= y}[op]
        return F.coalesce(real & test, no)
    if op == "IN":
        return F.coalesce(low.isin([as_text(v).lower() for v in value]), no) if isinstance(value, list) and value else no
    if op == "REGEX":
        return F.coalesce(field.rlike(rf"\A(?:{text})\z"), no) if valid_pattern(text) else no
    tests = {"CONTAINS": lambda: low.contains(lit_low), "NOT_CONTAINS": lambda: ~low.contains(lit_low), "STARTS_WITH": lambda: low.startswith(lit_low), "ENDS_WITH": lambda: low.endswith(lit_low)}
    return F.coalesce(tests[op](), no) if op in tests else no


def compile_filter(node: dict[str, Any] | None, sets: dict[str, frozenset[str]] | None = None) -> Column:
    """A tree: none and empty groups are true, AND needs all, any other logic needs one, unknown nodes are false."""
    if node is None:
        return F.lit(True)
    kind = str(node.get("type") or "").lower()
    if kind == "group":
        parts = [compile_filter(c, sets) for c in node.get("conditions") or ()]
        if not parts:
            return F.lit(True)
        both = str(node.get("logic") or "").upper() == "AND"
        return reduce(lambda a, b: (a & b) if both else (a | b), parts)
    return leaf(node, sets) if kind == "condition" else F.lit(False)


def topic_matches(topic: str) -> Column:
    """Events without a topic match nothing; the empty topic matches all others."""
    known = F.col("source_topic").isNotNull()
    return known & (F.lower("source_topic") == topic.lower()) if topic else known


def in_set(events: DataFrame, path: str, members: DataFrame, column: str) -> DataFrame:
    """Membership in a set too large for literals: a semi-join, broadcast only if Spark finds it small."""
    return events.join(members.select(F.col(column).alias("_member")).distinct(), extract(path) == F.col("_member"), "left_semi")
