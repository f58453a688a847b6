"""Type-2 slowly changing dimensions as a join and a rewrite (plain parquet has no MERGE)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suturestar.operators.keys import add_keys, next_key
from suturestar.operators.rows import one_per_key

VERSION = ("effective_date", "expiration_date", "is_current")


def with_parent_key(snapshot: DataFrame, parent: DataFrame, on: str, parent_key: str) -> DataFrame:
    """Add the surrogate key of the parent's current version (NULL when there is none)."""
    return snapshot.join(parent.filter("is_current").select(on, parent_key), on, "left")


def differs(columns: Sequence[str]) -> str:
    """SQL: `old` and `new` differ in some column, NULL counted as a value."""
    return " or ".join(f"not (old.`{c}` <=> new.`{c}`)" for c in columns) or "false"


def scd2_changes(
    current: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: date,
    mode: str = "changed",
    order: Sequence[str] = (),
) -> DataFrame:
    """Every row of the next state of the dimension, with a `change` label.

    history: an expired version, passed through.  absent: current, not in the snapshot, kept.
    same: kept, its untracked attributes taken from the snapshot.  new: first version of a key, effective from its snapshot date (else `as_of`).
    closed and changed: the old version ends the day before `as_of`, the new one starts on it.
    amended: changed again on the day its version started, rewritten in place.

    mode='changed' compares `tracked` NULL-safely; mode='reference' replaces every key in the snapshot.
    Expired versions skip the join, so both of its sides hold one row per key.  Each pair yields its
    one or two rows in one pass.
    """
    if mode not in ("changed", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    columns = current.columns
    attributes = [c for c in columns if c != key and c not in VERSION and c in snapshot.columns]
    fresh_columns = [*attributes, *(["effective_date"] if "effective_date" in snapshot.columns else [])]
    types = {f.name: f.dataType.simpleString() for f in current.schema.fields}

    fresh = one_per_key(snapshot, [key], order)
    old = current.filter("is_current").select(key, F.struct(*columns).alias("old"))
    new = fresh.select(key, F.struct(*fresh_columns).alias("new"))
    pairs = old.join(new, key, "full_outer")

    run_day = f"date '{as_of.isoformat()}'"
    first_day = f"coalesce(new.effective_date, {run_day})" if "effective_date" in fresh_columns else run_day

    def row(label: str, **values: str) -> str:
        """A struct of the dimension's columns: those given, the others from the old version."""
        parts = [f"'{c}', cast({values.get(c, f'old.`{c}`')} as {types[c]})" for c in columns]
        return f"named_struct({', '.join(parts)}, 'change', '{label}')"

    from_new = {c: f"new.`{c}`" for c in attributes}
    blank = {c: "null" for c in columns if c not in attributes and c not in VERSION and c != key}
    fresh_row = {key: f"`{key}`", **from_new, **blank, "expiration_date": "null", "is_current": "true"}

    # Attributes that are not versioned are refreshed in place.
    absent, same = row("absent"), row("same", **{c: v for c, v in from_new.items() if c not in tracked})
    first = row("new", **fresh_row, effective_date=first_day)
    closed = row("closed", expiration_date=f"date_sub({run_day}, 1)", is_current="false")
    changed = row("changed", **fresh_row, effective_date=run_day)
    amended = row("amended", **from_new)

    is_changed = "true" if mode == "reference" else differs(tracked)
    state = pairs.select(
        F.expr(
            f"""inline(case when new is null then array({absent})
                when old is null then array({first})
                when not ({is_changed}) then array({same})
                when old.effective_date >= {run_day} then array({amended})
                else array({closed}, {changed}) end)"""
        )
    )
    history = current.filter("not is_current").withColumn("change", F.lit("history"))
    return history.unionByName(state)


def scd2_merge(
    current: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: date,
    mode: str = "changed",
    surrogate: str | None = None,
    order: Sequence[str] = (),
    keep_change: bool = False,
) -> DataFrame:
    """The next state of the dimension; inserted versions get keys after the largest in use."""
    state = scd2_changes(current, snapshot, key, tracked, as_of, mode, order)
    if surrogate is not None:
        inserted = F.col("change").isin("new", "changed")
        numbered = add_keys(
            state.filter(inserted).drop(surrogate),
            surrogate,
            [key],
            start=next_key(current, surrogate),
            dtype=current.schema[surrogate].dataType.simpleString(),
        )
        state = state.filter(~inserted).unionByName(numbered)
    state = state.select(*current.columns, "change")
    return state if keep_change else state.drop("change")


def version_months(dim: DataFrame, key: str, columns: Sequence[str], first: Column, last: Column) -> DataFrame:
    """The versions of `dim` once for every month, from that of `first` to that of `last`, in which they are valid.

    Nothing when `first` is NULL.
    """
    begin = F.greatest("effective_date", first)
    end = F.least(F.coalesce("expiration_date", last), last)
    months = F.sequence(F.trunc(begin, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    return dim.select(
        F.col(key),
        F.col("effective_date").alias("from__"),
        F.col("expiration_date").alias("to__"),
        *columns,
        F.explode(F.when(first.isNotNull() & (begin <= end), months)).alias("month__"),
    )


def version_as_of(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    day: str,
    columns: Sequence[str],
    how: str = "inner",
    span: tuple[date, date] | None = None,
) -> DataFrame:
    """Join each fact row to the version of its business key that was valid on `day`.

    The join is on key and month; days decide within a month only.  So a fact row meets the few versions of its own
    month, not the key's whole history, and a key that holds much of the fact is spread over its months.  Versions are
    cut to the fact's own span, which bounds open and sentinel dates: `span` if given (rows outside it match nothing),
    else a pass over the fact's `day` column finds it.

    The join is asked to merge: Spark takes the versions' months for as small as the versions and would send them
    whole to every task.
    """
    if span is None:
        first, last = (fact.agg(f(F.to_date(day))).scalar() for f in (F.min, F.max))
    else:
        first, last = (F.lit(d) for d in span)
    f, v = fact.alias("f"), version_months(dim, key, columns, first, last).hint("merge").alias("v")
    month = F.trunc(F.to_date(F.col(f"f.{day}")), "month")
    same = (F.col(f"f.{key}") == F.col(f"v.{key}")) & (month == F.col("v.month__"))
    valid = (F.col("v.from__") <= F.col(f"f.{day}")) & (F.col("v.to__").isNull() | (F.col(f"f.{day}") <= F.col("v.to__")))
    return f.join(v, same & valid, how).select("f.*", *[F.col(f"v.{c}") for c in columns])
