"""Threshold expressions: a small expression language with one parser and two back ends, Columns and plain values.

Numbers, strings, true, false, null, names, ( ), unary - ! not, empty, size, * / % div mod, + -, < <= > >= lt le gt ge, == != eq ne,
=~ !~ (whole match), =^ !^ (starts), =$ !$ (ends), && and, || or, ?:, the short form ?: and ??.
Null counts as 0 in arithmetic, is equal to null only, and no order holds with it. Division by zero gives 0. Where one side is a number the
other counts as one, too; a string that is none satisfies no comparison with it. An expression that is no boolean, or that this grammar lacks, is false.
"""

from __future__ import annotations

import logging
import math
import operator
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
TOKEN = re.compile(r"\s*(?:(\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_$][\w$.]*)|(&&|\|\||==|!=|<=|>=|=~|!~|=\^|!\^|=\$|!\$|\?\?|\?:|[-+*/%<>!?:()]))")
WORDS = {"and": "&&", "or": "||", "not": "!", "eq": "==", "ne": "!=", "lt": "<", "le": "<=", "gt": ">", "ge": ">=", "div": "/", "mod": "%"}
TEXT_TESTS = ("=~", "!~", "=^", "!^", "=$", "!$")
POWER = {"?": 1, "?:": 1, "??": 1, "||": 2, "&&": 3, "==": 4, "!=": 4, **dict.fromkeys(TEXT_TESTS, 4), "<": 5, "<=": 5, ">": 5, ">=": 5, "+": 6, "-": 6, "*": 7, "/": 7, "%": 7}


class BadExpression(ValueError):
    pass


def tokens(text: str) -> list[tuple[str, str]]:
    out, at, text = [], 0, text.rstrip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise BadExpression(f"can't read {text[at:at + 20]!r}")
        at = m.end()
        if m[1]:
            out.append(("number", m[1]))
        elif m[2]:
            out.append(("string", re.sub(r"\\(.)", r"\1", m[2][1:-1])))
        elif m[3]:
            out.append(("op", WORDS[m[3]]) if m[3] in WORDS else ("name", m[3]))
        else:
            out.append(("op", m[4]))
    return out


class Parser:
    """Precedence climbing; what a value is, and what is done with it, is the back end's matter."""

    def __init__(self, text: str, back: Columns | Plain):
        self.all, self.at, self.back = tokens(text), 0, back

    def peek(self) -> tuple[str, str]:
        return self.all[self.at] if self.at < len(self.all) else ("end", "")

    def take(self, op: str | None = None) -> tuple[str, str]:
        now = self.peek()
        if op is not None and now != ("op", op):
            raise BadExpression(f"{op!r} expected, {now[1]!r} found")
        self.at += 1
        return now

    def whole(self):
        out = self.expression(0)
        if self.peek()[0] != "end":
            raise BadExpression(f"{self.peek()[1]!r} is not expected")
        return out

    def expression(self, least: int):
        left, back = self.unary(), self.back
        while self.peek()[0] == "op" and POWER.get(self.peek()[1], 0) > least:
            op = self.take()[1]
            if op == "?":
                yes = self.expression(0)
                self.take(":")
                left = back.choose(back.truth(left), yes, self.expression(0))
            elif op in ("?:", "??"):
                other = self.expression(0)
                left = back.choose(back.truth(left) if op == "?:" else back.present(left), left, other)
            else:
                left = back.binary(op, left, self.expression(POWER[op]))
        return left

    def unary(self):
        kind, text = self.take()
        if (kind, text) == ("op", "-"):
            return self.back.negative(self.unary())
        if (kind, text) == ("op", "!"):
            return self.back.inverse(self.unary())
        if (kind, text) == ("op", "("):
            inside = self.expression(0)
            self.take(")")
            return inside
        if kind == "number":
            return self.back.literal("number", float(text))
        if kind == "string":
            return self.back.literal("string", text)
        if kind == "name" and text in ("true", "false"):
            return self.back.literal("boolean", text == "true")
        if kind == "name" and text == "null":
            return self.back.literal("null", None)
        if kind == "name" and text in ("empty", "size") and self.peek()[0] in ("name", "string", "number") + ("op",) * (self.peek()[1] == "("):
            return getattr(self.back, text)(self.unary())
        if kind == "name":
            return self.back.name(text) or self.back.literal("null", None)
        raise BadExpression(f"{text or 'the end'!r} is not expected")


class Columns:
    """Values are (kind, Column): number, string, boolean or null, or ``any``, whose kind is known when it runs.

    The Column of an ``any`` is a struct of that kind and the value as text.
    """

    def __init__(self, names: Callable[[str], tuple[str, Column] | None]):
        self.name = names

    def literal(self, kind: str, value) -> tuple[str, Column]:
        return kind, F.lit(value)

    def as_any(self, value: tuple[str, Column]) -> Column:
        kind, c = value
        return c if kind == "any" else F.struct(F.lit(kind).alias("kind"), c.cast("string").alias("text"))

    def kind_is(self, value: tuple[str, Column], *kinds: str) -> Column:
        return value[1]["kind"].isin(*kinds) if value[0] == "any" else F.lit(value[0] in kinds)

    def present(self, value) -> Column:
        kind, c = value
        return F.lit(False) if kind == "null" else ~self.kind_is(value, "null") if kind == "any" else c.isNotNull()

    def truth(self, value) -> Column:
        kind, c = value
        if kind == "boolean":
            return F.coalesce(c, F.lit(False))
        if kind == "number":
            return F.coalesce((c != 0) & ~F.isnan(c), F.lit(False))
        if kind == "string":
            return F.coalesce(F.lower(c) == "true", F.lit(False))
        if kind == "any":
            return F.when(self.kind_is(value, "number"), self.truth(("number", self.number(value)))).when(self.kind_is(value, "boolean", "string"), self.truth(("string", c["text"]))).otherwise(F.lit(False))
        return F.lit(False)

    def number(self, value) -> Column:
        """As a double: null where it is none; booleans are 1 and 0."""
        kind, c = value
        if kind == "number":
            return c.cast("double")
        if kind == "boolean":
            return c.cast("int").cast("double")
        if kind == "string":
            return c.try_cast("double")
        if kind == "any":
            return F.when(self.kind_is(value, "boolean"), (c["text"] == "true").cast("int").cast("double")).when(self.kind_is(value, "number", "string"), c["text"].try_cast("double"))
        return F.lit(None).cast("double")

    def arithmetic(self, value) -> Column:
        return F.coalesce(self.number(value), F.lit(0.0))

    def text(self, value) -> Column:
        return value[1]["text"] if value[0] == "any" else value[1].cast("string")

    def negative(self, value):
        return "number", -self.arithmetic(value)

    def inverse(self, value):
        return "boolean", ~self.truth(value)

    def empty(self, value):
        kind = value[0]
        none = self.kind_is(value, "null") | (F.lit(False) if kind == "any" else F.coalesce(value[1].isNull(), F.lit(True)))
        zero = self.kind_is(value, "number") & F.coalesce((self.number(value) == 0) | F.isnan(self.number(value)), F.lit(False))
        return "boolean", none | zero | (self.kind_is(value, "string") & F.coalesce(self.text(value) == "", F.lit(False)))

    def size(self, value):
        return "number", F.when(~self.present(value), F.lit(0.0)).when(self.kind_is(value, "string"), F.length(self.text(value)).cast("double"))

    def choose(self, test: Column, yes, no):
        if yes[0] == no[0] and yes[0] != "any":
            return yes[0], F.when(test, yes[1]).otherwise(no[1])
        return "any", F.when(test, self.as_any(yes)).otherwise(self.as_any(no))

    def binary(self, op: str, a, b):
        if op in ("&&", "||"):
            return "boolean", self.truth(a) & self.truth(b) if op == "&&" else self.truth(a) | self.truth(b)
        if op in ("+", "-", "*", "/", "%"):
            x, y = self.arithmetic(a), self.arithmetic(b)
            if op in "/%":
                return "number", F.when(y == 0, F.lit(0.0)).otherwise(F.try_divide(x, y) if op == "/" else x % F.when(y == 0, F.lit(1.0)).otherwise(y))
            return "number", x + y if op == "+" else x - y if op == "-" else x * y
        if op in TEXT_TESTS:
            if {a[0], b[0]} - {"string", "any"}:
                raise BadExpression(f"{op} needs strings")
            x, y = self.text(a), self.text(b)
            test = {"~": lambda: F.regexp_like(x, F.concat(F.lit(r"\A(?:"), y, F.lit(r")\z"))), "^": lambda: F.startswith(x, y), "$": lambda: F.endswith(x, y)}[op[1]]()
            both = self.kind_is(a, "string") & self.kind_is(b, "string")
            return "boolean", F.coalesce(both & (test if op[0] == "=" else ~test), F.lit(False))
        return "boolean", self.compare(op, a, b)

    def compare(self, op: str, a, b) -> Column:
        no = F.lit(False)
        if "null" in (a[0], b[0]) and op not in ("==", "!="):
            return no
        if op in ("==", "!="):
            x, y = self.present(a), self.present(b)
            same = F.when(~x & ~y, F.lit(True)).when(~x | ~y, no).otherwise(self.order("==", a, b))
            unlike = F.when(~x & ~y, no).when(~x | ~y, F.lit(True)).otherwise(self.order("!=", a, b))
            return F.coalesce(same if op == "==" else unlike, no)
        return F.coalesce(self.present(a) & self.present(b) & self.order(op, a, b), no)

    def order(self, op: str, a, b) -> Column:
        """Of two values that are not null: as numbers if either is one, else as booleans if either is one, else as texts."""
        test = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}[op]

        def by_number() -> Column:
            x, y = self.number(a), self.number(b)
            nan = F.isnan(x) | F.isnan(y)
            return (nan | test(x, y)) if op == "!=" else ~nan & test(x, y)

        def by_truth() -> Column:
            return test(self.truth(a).cast("int"), self.truth(b).cast("int"))

        def by_text() -> Column:
            return test(self.text(a), self.text(b))

        kinds = {a[0], b[0]}
        if "any" not in kinds:
            return by_number() if "number" in kinds else by_truth() if "boolean" in kinds else by_text()
        either = lambda kind: self.kind_is(a, kind) | self.kind_is(b, kind)
        return F.when(either("other"), F.lit(False)).when(either("number"), by_number()).when(either("boolean"), by_truth()).otherwise(by_text())


class Plain:
    """The same on plain values (kind, value), for state operators."""

    def __init__(self, values: dict[str, float]):
        self.values = values

    def name(self, name: str):
        return ("number", self.values[name]) if name in self.values else None

    def literal(self, kind: str, value):
        return kind, value

    def present(self, value) -> bool:
        return value[1] is not None

    def truth(self, value) -> bool:
        kind, x = value
        return x if kind == "boolean" else x is not None and x != 0 and not math.isnan(x) if kind == "number" else kind == "string" and x.lower() == "true"

    def number(self, value) -> float | None:
        try:
            return None if value[1] is None else float(value[1])
        except ValueError:
            return None

    def arithmetic(self, value) -> float:
        return self.number(value) or 0.0

    def negative(self, value):
        return "number", -self.arithmetic(value)

    def inverse(self, value):
        return "boolean", not self.truth(value)

    def empty(self, value):
        kind, x = value
        return "boolean", x is None or x == "" or kind == "number" and (x == 0 or math.isnan(x))

    def size(self, value):
        return "number", 0.0 if value[1] is None else float(len(value[1])) if value[0] == "string" else None

    def choose(self, test: bool, yes, no):
        return yes if test else no

    def binary(self, op: str, a, b):
        if op in ("&&", "||"):
            return "boolean", (self.truth(a) and self.truth(b)) if op == "&&" else (self.truth(a) or self.truth(b))
        if op in ("+", "-", "*", "/", "%"):
            x, y = self.arithmetic(a), self.arithmetic(b)
            if op in "/%":
                return "number", 0.0 if y == 0 else x / y if op == "/" else math.fmod(x, y)
            return "number", {"+": operator.add, "-": operator.sub, "*": operator.mul}[op](x, y)
        if op in TEXT_TESTS:
            if {a[0], b[0]} != {"string"}:
                raise BadExpression(f"{op} needs strings")
            test = {"~": lambda: bool(re.fullmatch(b[1], a[1])), "^": lambda: a[1].startswith(b[1]), "$": lambda: a[1].endswith(b[1])}[op[1]]()
            return "boolean", test == (op[0] == "=")
        test = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}[op]
        if a[1] is None or b[1] is None:
            return "boolean", test(a[1] is None, b[1] is None) if op in ("==", "!=") else False
        if "number" in (a[0], b[0]):
            x, y = self.number(a), self.number(b)
            return "boolean", x is not None and y is not None and test(x, y)
        if "boolean" in (a[0], b[0]):
            return "boolean", test(self.truth(a), self.truth(b))
        return "boolean", test(a[1], b[1])


def compile_having(text: str | None, names: Callable[[str], tuple[str, Column] | None]) -> Column:
    """The expression as a boolean Column that is never null; blank, ill-formed and non-boolean ones are false."""
    if text is None or not text.strip():
        return F.lit(False)
    back = Columns(names)
    try:
        value = Parser(text, back).whole()
    except BadExpression as e:
        log.warning("threshold %r is false: %s", text, e)
        return F.lit(False)
    if value[0] not in ("boolean", "any"):
        return F.lit(False)
    return F.coalesce(back.kind_is(value, "boolean") & back.truth(value), F.lit(False))


def evaluate(text: str | None, values: dict[str, Any]) -> bool:
    """The same on plain numbers by alias."""
    if not text or not text.strip():
        return False
    try:
        kind, value = Parser(text, Plain(values)).whole()
    except BadExpression:
        return False
    return kind == "boolean" and bool(value)


def names_in(text: str | None) -> frozenset[str]:
    """All names in an expression."""
    try:
        return frozenset(t for kind, t in tokens(text or "") if kind == "name")
    except BadExpression:
        return frozenset()


def over_aliases(aliases: list[str]) -> Callable[[str], tuple[str, Column] | None]:
    known = {a: F.col(f"`{a}`") for a in aliases}
    return lambda name: ("number", known[name]) if name in known else None


def over_events(name: str) -> tuple[str, Column]:
    """A top-level field of an event, with the kind that it has in its JSON; objects and arrays are of a kind that satisfies nothing."""
    from .fields import ENVELOPE, extract

    if name in ENVELOPE:
        return ("string" if name == "_source_topic" else "number"), F.col(ENVELOPE[name])
    if name == "_data":
        return "string", F.col("data")
    shape = F.schema_of_variant(F.try_variant_get(F.try_parse_json("raw"), "$['" + name.replace("'", "") + "']", "variant"))
    text = extract(name)
    kind = F.when(text.isNull(), "null").when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean").when(shape.rlike("^(OBJECT|ARRAY)"), "other").otherwise("number")
    return "any", F.struct(kind.alias("kind"), text.alias("text"))
