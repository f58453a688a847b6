"""Samples that wait for their procedure, in hash buckets of its id.

The store below `<root>/orphan_samples` only grows by appends, `arrived=<day>/bucket=<b>`: a batch writes its own orphans and
rewrites nothing.  When procedures come, only the buckets that their ids hash to are read.  Samples that have found their
procedure stay as they are, since their procedure is not new a second time; a whole day of arrivals leaves at once when
it is too old, and what of it never found a procedure is kept below `<root>/expired_samples`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from suturestar.schemas import TELEMETRY_STAGE_DDL
from suturestar.sources.files import exists, file_system, remove

STORE, EXPIRED = "orphan_samples", "expired_samples"
BUCKETS = 64


def bucket_of(procedure_id: str) -> Column:
    return F.pmod(F.xxhash64(procedure_id), F.lit(BUCKETS)).cast("int")


def any_waiting(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root}/{STORE}")


def keep(orphans: DataFrame, root: str, arrived: date, watch: Callable[[DataFrame], DataFrame]) -> None:
    placed = orphans.withColumn("arrived", F.lit(arrived)).withColumn("bucket", bucket_of("procedure_id"))
    watch(placed.hint("rebalance", F.col("bucket"))).write.mode("append").partitionBy("arrived", "bucket").parquet(f"{root}/{STORE}")


def stored(spark: SparkSession, root: str, buckets: Iterable[int] | None = None) -> DataFrame:
    """All that came without its procedure, or that part of it in some buckets."""
    df = spark.read.schema(f"{TELEMETRY_STAGE_DDL}, arrived date, bucket int").parquet(f"{root}/{STORE}")
    return df if buckets is None else df.filter(F.col("bucket").isin(sorted(buckets)))


def answered(spark: SparkSession, root: str, new: DataFrame) -> DataFrame:
    """The stored samples of procedures in `new`; other buckets are not read."""
    ids = new.select("procedure_id")
    hit = [r.bucket for r in ids.select(bucket_of("procedure_id").alias("bucket")).distinct().collect()]
    return stored(spark, root, hit).join(ids, "procedure_id", "left_semi").drop("arrived", "bucket")


def expire(spark: SparkSession, root: str, before: date, procedures: DataFrame) -> int:
    """Take the arrivals of days before `before` out of the store; how many never found a procedure."""
    if not any_waiting(spark, root):
        return 0
    fs, p = file_system(spark, f"{root}/{STORE}")
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    old = [n for n in names if n.startswith("arrived=") and date.fromisoformat(n.partition("=")[2]) < before]
    if not old:
        return 0
    seen = Observation(EXPIRED)
    left = stored(spark, root).filter(F.col("arrived") < F.lit(before)).join(procedures.select("procedure_id"), "procedure_id", "left_anti")
    left.drop("bucket").observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(f"{root}/{EXPIRED}")
    for n in old:
        remove(spark, f"{root}/{STORE}/{n}")
    return seen.get["rows"]
