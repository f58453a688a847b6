"""Measures that can be aggregated in two steps.

A measure knows (a) the mergeable sums, counts and extremes it needs and (b) how to finish from
them.  A report over a huge fact then first shrinks the fact to one row per foreign key
(`partials`), joins only those rows with the dimensions, and merges to the report's groups
(`combine`).  The raw fact is never shuffled to a dimension, so neither a large dimension nor a
key that holds a third of the fact makes one task slow: the first step is a map-side combine.
`summarise` is the one-step form for reports that need no dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Expr = str | Column


def _col(c: Expr) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Slot:
    """One mergeable aggregate; `partial` is None when it is computed only at the merge."""

    name: str
    partial: Column | None
    merge: Callable[[Column], Column]


@dataclass(frozen=True)
class Measure:
    name: str
    slots: tuple[Slot, ...]
    finish: Column


def _row_slot() -> Slot:
    return Slot("n_rows__", F.count(F.lit(1)), F.sum)


def _sum_slot(c: Column, tag: str) -> Slot:
    return Slot(f"{tag}__sum", F.sum(c), F.sum)


def _count_slot(c: Column, tag: str) -> Slot:
    return Slot(f"{tag}__n", F.count(c), F.sum)


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def _ratio(numerator: str, denominator: str) -> Column:
    return F.col(numerator).cast("double") / F.nullif(F.col(denominator), F.lit(0)).cast("double")


def rows(name: str) -> Measure:
    """COUNT(*)."""
    return Measure(name, (_row_slot(),), F.col("n_rows__"))


def average(name: str, c: Expr, digits: int | None = None) -> Measure:
    """AVG as a double, the fraction kept for integers too; NULLs are left out."""
    e = _col(c)
    return Measure(
        name, (_sum_slot(e, name), _count_slot(e, name)), _round(_ratio(f"{name}__sum", f"{name}__n"), digits)
    )


def average_if(name: str, cond: Column, c: Expr, digits: int | None = None) -> Measure:
    """AVG over the rows where `cond` holds; NULL when there are none."""
    return average(name, F.when(cond, _col(c)), digits)


def hours(name: str, minutes: Expr, digits: int | None = None) -> Measure:
    """SUM of minutes as hours."""
    return Measure(
        name,
        (_sum_slot(_col(minutes), name),),
        _round(F.col(f"{name}__sum").cast("double") / F.lit(60.0), digits),
    )


def hits(name: str, cond: Column) -> Measure:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END)."""
    return Measure(name, (Slot(f"{name}__hits", F.count_if(cond), F.sum),), F.col(f"{name}__hits"))


def rate(name: str, cond: Column, digits: int | None = None) -> Measure:
    """Share of rows where `cond` holds, in percent; NULL for no rows."""
    return Measure(
        name,
        (Slot(f"{name}__hits", F.count_if(cond), F.sum), _row_slot()),
        _round(_ratio(f"{name}__hits", "n_rows__") * 100, digits),
    )


def low(name: str, c: Expr) -> Measure:
    return Measure(name, (Slot(f"{name}__min", F.min(_col(c)), F.min),), F.col(f"{name}__min"))


def high(name: str, c: Expr, digits: int | None = None) -> Measure:
    return Measure(name, (Slot(f"{name}__max", F.max(_col(c)), F.max),), _round(F.col(f"{name}__max"), digits))


def distinct(name: str, key: str) -> Measure:
    """COUNT(DISTINCT key); `key` must be one of the keys of the first step, or the step be one."""
    slot = Slot(f"{name}__distinct", None, lambda _c: F.count_distinct(F.col(key)))
    return Measure(name, (slot,), F.col(slot.name))


def groups(name: str) -> Measure:
    """Number of first-step rows: COUNT(DISTINCT k) when k alone is the first step's key."""
    slot = Slot(f"{name}__groups", None, lambda _c: F.count(F.lit(1)))
    return Measure(name, (slot,), F.col(slot.name))


def _slots(measures: Sequence[Measure]) -> list[Slot]:
    return list({s.name: s for m in measures for s in m.slots}.values())


def _finish(df: DataFrame, by: Sequence[Expr], measures: Sequence[Measure]) -> DataFrame:
    n_keys = len(by)
    keys = [F.col(f"`{c}`") for c in df.columns[:n_keys]]
    return df.select(*keys, *[m.finish.alias(m.name) for m in measures])


def partials(df: DataFrame, by: Sequence[Expr], measures: Sequence[Measure]) -> DataFrame:
    """Step one: the mergeable slots per `by`, with map-side combine."""
    aggs = [s.partial.alias(s.name) for s in _slots(measures) if s.partial is not None]
    return df.groupBy(*by).agg(*aggs)


def combine(df: DataFrame, by: Sequence[Expr], measures: Sequence[Measure]) -> DataFrame:
    """Step two: merge the slots to `by` and finish every measure."""
    merged = df.groupBy(*by).agg(*[s.merge(F.col(s.name)).alias(s.name) for s in _slots(measures)])
    return _finish(merged, by, measures)


def summarise(df: DataFrame, by: Sequence[Expr], measures: Sequence[Measure]) -> DataFrame:
    """Both steps at once, for groups that live on `df` itself."""
    aggs = [
        (s.merge(F.lit(None)) if s.partial is None else s.partial).alias(s.name) for s in _slots(measures)
    ]
    return _finish(df.groupBy(*by).agg(*aggs), by, measures)


def bucket(c: Expr, edges: Sequence[int], labels: Sequence[str], otherwise: str | None = None) -> Column:
    """Label of the half-open band a whole number falls in: below edges[0] is labels[0], and so on.

    A NULL gets `otherwise` (NULL when that is not given).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("bucket needs one label more than edges")
    e = _col(c)
    out = F.when(e < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        out = out.when(e < edge, label)
    out = out.when(e >= edges[-1], labels[-1])
    return out if otherwise is None else out.otherwise(otherwise)


def span_days(first: Expr, last: Expr) -> Column:
    """Days from `first` to `last`, both counted."""
    return F.datediff(_col(last), _col(first)) + 1
