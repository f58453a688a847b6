"""Dimension snapshots: write a whole new state beside the old one, then let readers see it.

A dimension is rewritten to `<root>/<table>/snapshot=<number of the write>`.  The write's commit record in the ledger is the
switch: readers take the newest committed number, so a failed run changes nothing, and a second writer is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from suturestar.sources import ledger
from suturestar.sources.files import exists, remove


def _path(root: str, table: str, number: int) -> str:
    return f"{root}/{table}/snapshot={number:08d}"


def committed(spark: SparkSession, root: str, table: str) -> list[str]:
    """Ids of the table's committed snapshots that are still there, oldest first."""
    return [f"{n:08d}" for n in ledger.commits(spark, root, table) if exists(spark, _path(root, table, n))]


def read_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    done = ledger.commits(spark, root, table)
    return spark.read.parquet(_path(root, table, done[-1])) if done else None


def drop_old(spark: SparkSession, root: str, table: str, keep: int = 2) -> list[str]:
    """Remove all but the newest `keep` committed snapshots; readers of the newest ones are not disturbed."""
    old = committed(spark, root, table)[: -max(1, keep)]
    for i in old:
        remove(spark, _path(root, table, int(i)))
    return old


def save(df: DataFrame, root: str, held: ledger.Claim) -> None:
    """Write the snapshot of a claimed write; it shows when the claim is committed."""
    df.write.mode("overwrite").parquet(_path(root, held.table, held.number))


def write_snapshot(df: DataFrame, root: str, table: str) -> str:
    """Claim, write and commit the next snapshot; its id."""
    with ledger.writing(df.sparkSession, root, table) as held:
        save(df, root, held)
    return f"{held.number:08d}"
