"""Small helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.session import brief_shuffles, scratch
from suturestar.sources.files import remove


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors.

    Nothing reads the write's shuffle files again, so they go with it instead of when the driver collects garbage.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with brief_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove tables that `kept` gave, when nothing reads them again."""
    for t in tables:
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            remove(t.sparkSession, folder)


def once(value: Column, use) -> Column:
    """`use(v)` with `value` evaluated a single time, also where `use` needs it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def fresh(prefix: str) -> str:
    """A column name that no input has."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def sliced(batches: Iterator[pa.RecordBatch], size: int, *columns: str) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices whose values in the string columns take about `size` bytes, or one row if that is longer."""
    for batch in batches:
        lengths = [pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
        total = np.cumsum(np.sum(lengths, axis=0))
        at = 0
        while at < batch.num_rows:
            base = int(total[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + size, "right")))
            yield batch.slice(at, end - at)
            at = end
