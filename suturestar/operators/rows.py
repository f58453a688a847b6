"""One row per key, and rows a target does not hold yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row per key by `order`; remaining ties go to the greatest remaining columns.

    Spark runs `row_number() = 1` as a group limit before the shuffle as well as after it, so each task
    sends one row per key and a key that holds a third of the rows stays small.  The choice does not
    depend on row order, so a recomputed partition gives the same row.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [F.desc(c) for c in (*order, *[c for c in rest if c not in order])]
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))
    return df.withColumn("rank__", newest).filter("rank__ = 1").drop("rank__")


def greatest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row per key that `one_per_key` gives without an `order`, as a grouped maximum.

    For wide rows that a join on `keys` has just sorted: the aggregate takes them in that order, where a window would
    sort them once more by all columns.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("best__"))
    return best.select(*[F.col(c) if c in keys else F.col("best__")[c].alias(c) for c in df.columns])


def only_new(stage: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `stage` whose key `target` lacks.

    The target is first cut down to the keys the stage holds.  For the usual small batch against a
    long history that is one column-pruned scan of the target without a shuffle (the batch's keys are
    broadcast when they measure small); only the hits meet the stage again.
    """
    hits = target.select(*keys).join(stage.select(*keys), list(keys), "left_semi")
    return stage.join(hits, list(keys), "left_anti")
