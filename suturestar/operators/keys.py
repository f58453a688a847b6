"""Dense surrogate keys without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bounds the rows of one numbering task to a 65,536th of the input, and the table of offsets to as many rows.
BUCKETS = 1 << 16


def next_key(table: DataFrame, key: str) -> Column:
    """The largest key in use (0 for an empty table), as a scalar subquery."""
    return F.coalesce(table.agg(F.max(key)).scalar(), F.lit(0))


def _numbered(df: DataFrame, order_cols: Sequence[str], buckets: int) -> DataFrame:
    """Rows with their hash bucket and their number within it.

    The bucket is a function of the data, not of the partition, so a retried task numbers its rows as
    before.
    """
    tagged = df.withColumn("bucket__", F.pmod(F.xxhash64(*order_cols), F.lit(buckets)))
    within = F.row_number().over(Window.partitionBy("bucket__").orderBy(*order_cols))
    return tagged.withColumn("within__", within)


def _with_number(df: DataFrame, key: str, number: Column, columns: Sequence[str], dtype: str) -> DataFrame:
    return df.select(number.cast(dtype).alias(key), *[F.col(c) for c in columns if c != key])


def _base(start: Column | int) -> Column:
    return F.lit(start) if isinstance(start, int) else start


def add_keys(
    df: DataFrame,
    key: str,
    order_cols: Sequence[str],
    start: Column | int = 0,
    buckets: int = BUCKETS,
    dtype: str = "bigint",
) -> DataFrame:
    """Number the rows start+1, start+2, ... without gaps; `order_cols` must identify a row.

    Bucket sizes give each bucket its offset (a table of at most `buckets` rows), and rows are numbered
    inside their bucket.  `df` is read twice, the first time only for `order_cols`.
    """
    numbered = _numbered(df, order_cols, buckets)
    sizes = (
        df.select(F.pmod(F.xxhash64(*order_cols), F.lit(buckets)).alias("bucket__"))
        .groupBy("bucket__")
        .agg(F.count(F.lit(1)).alias("size__"))
    )
    before = Window.orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket__", F.coalesce(F.sum("size__").over(before), F.lit(0)).alias("offset__"))
    number = _base(start) + F.col("offset__") + F.col("within__")
    return _with_number(numbered.join(offsets, "bucket__"), key, number, df.columns, dtype)


def add_sparse_keys(
    df: DataFrame, key: str, order_cols: Sequence[str], start: Column | int = 0, buckets: int = BUCKETS
) -> DataFrame:
    """Unique keys above `start` in one pass: buckets take turns, so keys have gaps where one is shorter.

    For fact loads, where reading the staged rows twice costs more than gaps in a BIGINT do; an identity
    column promises no more than this.
    """
    number = _base(start) + (F.col("within__") - 1).cast("bigint") * buckets + F.col("bucket__") + 1
    return _with_number(_numbered(df, order_cols, buckets), key, number, df.columns, "bigint")
