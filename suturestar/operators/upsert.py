"""Insert-or-update and cascading delete as pure DataFrame rewrites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suturestar.functions.timekeys import moment
from suturestar.operators.rows import only_new


def fold_updates(updates: DataFrame, key: str, update_cols: Sequence[str], order_col: str) -> DataFrame:
    """Many records per key as one: what applying them one by one in order would leave.

    The first record inserts every column, later ones overwrite only `update_cols`.  Records of one key
    with the same order value are ranked by their contents.
    """
    others = [c for c in updates.columns if c not in (key, order_col, *update_cols)]
    first = F.struct(order_col, *others, *update_cols)
    last = F.struct(F.col(order_col), *[F.col(c) for c in update_cols])
    folded = updates.groupBy(key).agg(F.min(first).alias("first__"), F.max(last).alias("last__"))
    picks = {c: "last__" for c in (*update_cols, order_col)}
    return folded.select(
        *[F.col(c) if c == key else F.col(f"{picks.get(c, 'first__')}.{c}").alias(c) for c in updates.columns]
    )


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    update_cols: Sequence[str],
    order_col: str,
    stamp: tuple[str, datetime] | None = None,
) -> DataFrame:
    """Insert unknown keys; for known ones replace only `update_cols` (and set the `stamp` column).

    A left join and an anti join rather than a full outer one: with a small batch of updates neither
    makes Spark shuffle the target.
    """
    folded = fold_updates(updates, key, update_cols, order_col)
    changes = folded.select(key, F.struct(*update_cols).alias("u__"))
    known = F.col("u__").isNotNull()
    stamped = None if stamp is None else moment(stamp[1]).cast(target.schema[stamp[0]].dataType)

    def column(c: str):
        if c in update_cols:
            return F.when(known, F.col(f"u__.{c}")).otherwise(F.col(c)).alias(c)
        if stamp is not None and c == stamp[0]:
            return F.when(known, stamped).otherwise(F.col(c)).alias(c)
        return F.col(c)

    kept = target.join(changes, key, "left").select(*[column(c) for c in target.columns])
    new = only_new(folded, target, [key]).select(
        *[
            (F.col(c) if c in folded.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    if stamp is not None:
        new = new.withColumn(stamp[0], F.coalesce(F.col(stamp[0]), stamped))
    return kept.unionByName(new)


def cascade_delete(
    tables: Mapping[str, DataFrame], root: str, root_key: str, doomed: DataFrame, links: Sequence[tuple[str, str, str]]
) -> dict[str, DataFrame]:
    """Delete the `doomed` keys of `root` and, along `links`, what refers to them.

    A link is (parent table, child table, parent's key = child's foreign key), parents before children.
    """
    gone = {root: tables[root].join(doomed.select(root_key), root_key, "left_semi")}
    out = dict(tables)
    out[root] = tables[root].join(doomed.select(root_key), root_key, "left_anti")
    for parent, child, fk in links:
        if parent not in gone:
            continue
        keys = gone[parent].select(fk)
        gone[child] = tables[child].join(keys, fk, "left_semi")
        out[child] = tables[child].join(keys, fk, "left_anti")
    return out


# Who refers to whom in the operational tables.
OPERATIONAL_LINKS = (
    ("surgical_robots", "surgical_procedures", "robot_id"),
    ("surgical_robots", "robot_maintenance_logs", "robot_id"),
    ("surgical_procedures", "procedure_outcomes", "procedure_id"),
)
