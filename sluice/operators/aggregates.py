"""Aggregates as partial, merge and final Columns, so that panes are shared by overlapping windows.

An exact distinct count keeps DISTINCT_CAP values of a pane at most, whatever the window: a window counts that many times its panes at most.
One whose specification is not capped counts them all.

The last digit of a sum of doubles depends on the order, and a threshold that a sum meets exactly depends on that digit. So sums that a threshold
names are ordered: their numbers are added up by offset, however the events are split among tasks. A partial is a list of terms, of events of one
run of offsets; above TERMS of them, it is their sum alone, so a group of any size is merged from few terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fields import extract, number
from ..plans.rules import Aggregation

#: Distinct values that an exact count keeps per pane.
DISTINCT_CAP = 50_000
HLL_BITS = 14
#: Offsets with equal upper bits are a run. Numbers of a run and group that are kept apart at most.
RUN_BITS, TERMS = 16, 256


@dataclass(frozen=True)
class Compiled:
    """One aggregate over a value column ``v`` of the routed events; ``exact`` distinct counts have no partials."""

    spec: Aggregation
    v: str
    ordered: bool = False

    @property
    def exact(self) -> bool:
        return self.spec.function == "COUNT_DISTINCT" and not self.spec.high_cardinality

    @property
    def value(self) -> Column | None:
        """What is read from each event."""
        f = self.spec.function
        if f in ("SUM", "AVG", "MIN", "MAX"):
            return number(extract(self.spec.field))
        if f == "COUNT_DISTINCT":
            text = extract(self.spec.field)
            # The sketch skips empty strings, which count; the exact count leaves them out.
            return F.concat(F.lit("v"), text) if self.spec.high_cardinality else F.when(text != "", text)
        return None

    def limited(self, count: Column, most: Column | None = None) -> Column:
        """An exact distinct count, up to the most that its panes keep, one pane by default."""
        return F.least(count, F.lit(DISTINCT_CAP) if most is None else most) if self.spec.capped else count

    def terms(self) -> Column:
        """The numbers of a run by offset, or their sum."""
        v = F.col(self.v)
        own = F.array_sort(F.collect_list(F.when(v.isNotNull(), F.struct("offset", v.alias("v")))))
        return F.when(F.size(own) > TERMS, F.array(F.struct(own[0]["offset"].alias("offset"), added(own).alias("v")))).otherwise(own)

    def partials(self) -> dict[str, Column]:
        """By name: aggregates of one value column share those of one kind."""
        f, v = self.spec.function, F.col(self.v)
        total = {f"{self.v}_terms": self.terms()} if self.ordered else {f"{self.v}_sum": F.sum(v)}
        if f == "COUNT":
            return {f"{self.v}_count": F.count(F.lit(1))}
        if f == "SUM":
            return total
        if f == "AVG":
            return total | {f"{self.v}_n": F.count(v)}
        if f in ("MIN", "MAX"):
            return {f"{self.v}_{f.lower()}": (F.min if f == "MIN" else F.max)(v)}
        if f == "COUNT_DISTINCT" and self.spec.high_cardinality:
            return {f"{self.v}_sketch": F.hll_sketch_agg(v, HLL_BITS)}
        return {}

    def merged(self) -> Column:
        """Over the panes of a window; a double, 0 where there were no values."""
        f, parts = self.spec.function, [F.col(name) for name in self.partials()]
        total = lambda: added(F.array_sort(F.flatten(F.collect_list(parts[0])))) if self.ordered else F.sum(parts[0])
        if f in ("COUNT", "SUM"):
            out = total()
        elif f == "AVG":
            out = F.try_divide(total(), F.sum(parts[1]))
        elif f in ("MIN", "MAX"):
            out = (F.min if f == "MIN" else F.max)(parts[0])
        elif f == "COUNT_DISTINCT" and not self.exact:
            out = F.hll_sketch_estimate(F.hll_union_agg(parts[0]))
        else:
            out = F.lit(0.0)
        return F.coalesce(out.cast("double"), F.lit(0.0)).alias(self.spec.alias)

    def direct(self) -> Column:
        """Over the events of a window in one step."""
        f, v = self.spec.function, F.col(self.v)
        by = {"COUNT": lambda: F.count(F.lit(1)), "SUM": lambda: F.sum(v), "AVG": lambda: F.avg(v), "MIN": lambda: F.min(v), "MAX": lambda: F.max(v)}
        if f == "COUNT_DISTINCT":
            out = self.limited(F.count_distinct(v)) if self.exact else F.hll_sketch_estimate(F.hll_sketch_agg(v, HLL_BITS))
        else:
            out = by.get(f, lambda: F.lit(0.0))()
        return F.coalesce(out.cast("double"), F.lit(0.0)).alias(self.spec.alias)

    def fresh(self, keys: list[str], order: list[str]) -> Column:
        """Whether a value of a distinct count is the first of its group in ``order``, as 1 or 0; its running sum is the running count."""
        first = F.row_number().over(W.partitionBy(*keys, self.v).orderBy(*order)) == 1
        return F.when(F.col(self.v).isNotNull() & first, 1).otherwise(0).alias(f"{self.v}_fresh")

    def running(self, over) -> Column:
        """After each event, within a window specification up to that event; distinct counts are over ``fresh``."""
        f, v = self.spec.function, F.col(self.v)
        by = {"COUNT": lambda: F.count(F.lit(1)).over(over), "SUM": lambda: F.sum(v).over(over), "AVG": lambda: F.avg(v).over(over), "MIN": lambda: F.min(v).over(over), "MAX": lambda: F.max(v).over(over), "COUNT_DISTINCT": lambda: F.sum(f"{self.v}_fresh").over(over)}
        out = by.get(f, lambda: F.lit(0.0))()
        return F.coalesce((self.limited(out) if self.exact else out).cast("double"), F.lit(0.0)).alias(self.spec.alias)


def added(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda total, t: total + t["v"])


def run_of_offsets() -> Column:
    return F.struct("partition", F.shiftright("offset", RUN_BITS).alias("run")).alias("_run")


def compile_all(specs: tuple[Aggregation, ...], named: frozenset[str] = frozenset()) -> list[Compiled]:
    """``named``: the aliases in the threshold."""
    first: dict[tuple, str] = {}
    at = [first.setdefault(("number", s.field) if s.function in ("SUM", "AVG", "MIN", "MAX") else (k,), f"_v{k}") for k, s in enumerate(specs)]
    return [Compiled(s, v, s.function in ("SUM", "AVG") and s.alias in named) for s, v in zip(specs, at, strict=True)]
