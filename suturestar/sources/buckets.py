"""Facts stored in hash buckets of a join key.

Rows of one key lie in one bucket, so a join or an aggregation on that key reads the buckets as they are and
shuffles nothing.  The files stay below the star's own folder, partitioned by time as before; a session's catalog only gets an
external table that names their layout.  Two tables with the same number of buckets meet bucket by bucket.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Layout:
    """How a fact lies on disk: time partition, bucket key and the order within a file."""

    partition: str
    kind: str
    key: str
    sort: tuple[str, ...]


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that Spark's own bucketed writer gives a key."""
    return F.pmod(F.hash(key), F.lit(buckets))


def declare(spark: SparkSession, path: str, schema: StructType, layout: Layout, buckets: int) -> str:
    """The name of the catalog table that describes the files below `path`."""
    name = f"star_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{layout.partition}` {layout.kind}) USING parquet "
        f"PARTITIONED BY ({layout.partition}) CLUSTERED BY ({layout.key}) SORTED BY ({', '.join(layout.sort)}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if spark.conf.get("spark.sql.catalogImplementation") == "hive":
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def read_bucketed(spark: SparkSession, path: str, schema: StructType, layout: Layout, buckets: int) -> DataFrame:
    return spark.table(declare(spark, path, schema, layout, buckets))


def append_bucketed(rows: DataFrame, path: str, schema: StructType, layout: Layout, buckets: int, watch=None) -> None:
    """Append rows that have the partition column.

    `rebalance` gathers each (partition, bucket) into few files and lets adaptive execution split a large one.
    """
    name = declare(rows.sparkSession, path, schema, layout, buckets)
    ready = rows.withColumn("bucket__", bucket_of(layout.key, buckets)).hint("rebalance", F.col(layout.partition), F.col("bucket__"))
    ready = ready.select(*[f.name for f in schema.fields], layout.partition)
    (ready if watch is None else watch(ready)).write.insertInto(name)
