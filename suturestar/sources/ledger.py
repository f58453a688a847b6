"""Commit records: who may write a table next, and what its last write left.

Each write of a table has a number n.  Below `<root>/_ledger/<table>` it creates `n.claim`, only if that is absent, before
it writes anything, and `n.commit` last.  A second writer finds the claim and is refused, so two loads never number rows
from the same base.  A write that raises leaves `n.failed`; one that dies leaves its bare claim, which others may
pass once it is STALE.  After either the last commit's values may lie below what is on disk, so the claim says it is
not `trusted` and the writer looks at the table itself.

A commit carries small values as JSON: the largest surrogate key given out, the number of buckets, and so on.
Creation only if absent is the file system's own promise (HDFS and conditional writes keep it).
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from suturestar.sources.files import exists, file_system

STALE = 6 * 3600.0


class Busy(RuntimeError):
    """Another writer holds the table."""


@dataclass
class Claim:
    """The right to make write `number`; `before` has the last commit's values, `values` those to be committed."""

    table: str
    number: int
    before: dict
    trusted: bool
    values: dict = field(default_factory=dict)


def _folder(root: str, table: str) -> str:
    return f"{root}/_ledger/{table}"


def _create(spark: SparkSession, path: str, text: str = "") -> bool:
    """Write a small file unless it is there; whether it was written."""
    fs, p = file_system(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _read(spark: SparkSession, path: str) -> dict:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _records(spark: SparkSession, root: str, table: str) -> dict[int, dict[str, float]]:
    """Per number the kinds of its records, with their time in seconds."""
    path = _folder(root, table)
    if not exists(spark, path):
        return {}
    fs, p = file_system(spark, path)
    out: dict[int, dict[str, float]] = {}
    for status in fs.listStatus(p):
        number, _, kind = status.getPath().getName().partition(".")
        out.setdefault(int(number), {})[kind] = status.getModificationTime() / 1000
    return out


def commits(spark: SparkSession, root: str, table: str) -> list[int]:
    """Numbers of the committed writes, oldest first."""
    return sorted(n for n, kinds in _records(spark, root, table).items() if "commit" in kinds)


def last(spark: SparkSession, root: str, table: str) -> dict:
    """The values of the last commit; empty when there is none."""
    done = commits(spark, root, table)
    return _read(spark, f"{_folder(root, table)}/{done[-1]:08d}.commit") if done else {}


def claim(spark: SparkSession, root: str, table: str, patience: float = 0.0, stale: float = STALE) -> Claim:
    """Claim the next write; while another is open, wait for `patience` seconds, then raise Busy."""
    give_up = time.time() + patience
    while True:
        records = _records(spark, root, table)
        done = max((n for n, kinds in records.items() if "commit" in kinds), default=0)
        after = {n: kinds for n, kinds in records.items() if n > done}
        if all("failed" in kinds or time.time() - kinds["claim"] > stale for kinds in after.values()):
            number = max(records, default=0) + 1
            if _create(spark, f"{_folder(root, table)}/{number:08d}.claim"):
                before = _read(spark, f"{_folder(root, table)}/{done:08d}.commit") if done else {}
                return Claim(table, number, before, not after)
        if time.time() >= give_up:
            raise Busy(f"{table} below {root} is being written")
        time.sleep(min(1.0, max(0.0, give_up - time.time())))


def commit(spark: SparkSession, root: str, held: Claim) -> None:
    """The write's last step: from here on readers and writers go by it."""
    values = {**held.before, **held.values}
    if not _create(spark, f"{_folder(root, held.table)}/{held.number:08d}.commit", json.dumps(values)):
        raise Busy(f"write {held.number} of {held.table} has been committed by another")


@contextmanager
def writing(spark: SparkSession, root: str, table: str, patience: float = 0.0) -> Iterator[Claim]:
    """Claim, let the body write, commit its `values`; a body that raises commits nothing."""
    held = claim(spark, root, table, patience)
    try:
        yield held
    except BaseException:
        _create(spark, f"{_folder(root, table)}/{held.number:08d}.failed")
        raise
    commit(spark, root, held)
