"""Surrogate keys for staged facts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suturestar.schemas import UNKNOWN_KEY


class Lookup(NamedTuple):
    dim: DataFrame
    business_key: str
    surrogate: str


def resolve_keys(stage: DataFrame, lookups: Mapping[str, Lookup]) -> tuple[DataFrame, DataFrame]:
    """Add the current version's surrogate key for every lookup, -1 where there is none.

    Returns (all rows with keys, the rows with at least one unknown member and which they are).
    """
    out = stage
    for lookup in lookups.values():
        members = lookup.dim.filter("is_current").select(lookup.business_key, lookup.surrogate)
        out = out.join(members, lookup.business_key, "left").withColumn(
            lookup.surrogate, F.coalesce(F.col(lookup.surrogate), F.lit(UNKNOWN_KEY))
        )
    unknown = F.filter(
        F.array(*[F.when(F.col(l.surrogate) == UNKNOWN_KEY, F.lit(name)) for name, l in lookups.items()]),
        lambda x: x.isNotNull(),
    )
    is_unknown = reduce(lambda a, b: a | b, [F.col(l.surrogate) == UNKNOWN_KEY for l in lookups.values()])
    return out, out.filter(is_unknown).withColumn("unknown_members", unknown)
