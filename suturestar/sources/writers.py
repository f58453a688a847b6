"""Sinks: staged CSV, fact appends, raw JSON landing, response envelopes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from suturestar.plans.telemetry import STAGE_COLUMNS
from suturestar.sources.buckets import Layout, append_bucketed
from suturestar.sources.files import remove

# Keeps microseconds, which Spark's own default drops.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def write_staged_csv(df: DataFrame, root: str, stamp: str, name: str) -> str | None:
    """Pipe-delimited CSV without a header under a date-stamped path; None (nothing written) for no rows."""
    path = f"{root.rstrip('/')}/etl-staging/{stamp}/{name}"
    seen = Observation(name)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("sep", "|").option("nullValue", "").option("emptyValue", "").option(
        "timestampNTZFormat", TIME_FORMAT
    ).csv(path)
    if seen.get["rows"]:
        return path
    remove(df.sparkSession, path)
    return None


def write_telemetry_stage(samples: DataFrame, root: str, stamp: str) -> str | None:
    """The 18 staged telemetry columns in their fixed order; other fields are left out."""
    return write_staged_csv(samples.select(*STAGE_COLUMNS), root, stamp, "telemetry")


def clustered(df: DataFrame, partition: str, *sort: str) -> DataFrame:
    """Spread rows so that each partition value lands in few files, large values in several.

    `rebalance` lets adaptive execution size the files and split a value that holds much of the data.
    """
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *sort)


Watch = Callable[[DataFrame], DataFrame]


# Months sorted by day and robot, days by procedure and time: the star's sort keys as file statistics.
LAYOUTS = {
    "fact_procedures": Layout("start_month", "integer", "procedure_key", ("start_date_key", "robot_key")),
    "fact_procedure_telemetry": Layout("sample_date", "date", "procedure_key", ("procedure_key", "sample_timestamp")),
}


def with_partition(table: str, rows: DataFrame) -> DataFrame:
    """The rows of a fact with the column that it is partitioned by."""
    if table == "fact_procedures":
        return rows.withColumn("start_month", F.expr("start_date_key div 100").cast("int"))
    return rows.withColumn("sample_date", F.to_date("sample_timestamp"))


def append_fact(table: str, rows: DataFrame, path: str, watch: Watch | None = None, buckets: int = 0) -> None:
    """Append to a fact's time partitions, in `buckets` of its procedure key if that is not 0.

    `watch` is applied last, in the writing stage, where Spark counts each task once even when it is retried.
    """
    layout, ready = LAYOUTS[table], with_partition(table, rows)
    if buckets:
        append_bucketed(ready, path, rows.schema, layout, buckets, watch)
        return
    ready = clustered(ready, layout.partition, *layout.sort)
    (ready if watch is None else watch(ready)).write.mode("append").partitionBy(layout.partition).parquet(path)


def append_procedures(facts: DataFrame, path: str, watch: Watch | None = None) -> None:
    append_fact("fact_procedures", facts, path, watch)


def append_telemetry(rows: DataFrame, path: str, watch: Watch | None = None) -> None:
    append_fact("fact_procedure_telemetry", rows, path, watch)


def land_batch(records: DataFrame, path: str, record_type: str | None = None) -> None:
    """Raw records as JSON under `type=...`; records without a type are telemetry."""
    if record_type is not None:
        typed = records.withColumn("type", F.lit(record_type))
    elif "type" in records.columns:
        typed = records.withColumn("type", F.coalesce("type", F.lit("telemetry")))
    else:
        typed = records.withColumn("type", F.lit("telemetry"))
    typed.write.mode("append").partitionBy("type").option("timestampNTZFormat", TIME_FORMAT).json(path)


def envelope(page: DataFrame, limit: int, offset: int, order: list, name: str = "rows") -> DataFrame:
    """One row: the page's count, limit, offset and its rows as JSON.

    Only for a page: its `limit` bounds what is gathered into the one row.
    """
    bounded = page.limit(limit)
    numbered = bounded.select(F.struct(*page.columns).alias("row"), F.row_number().over(Window.orderBy(*order)).alias("at"))
    gathered = F.transform(F.array_sort(F.collect_list(F.struct("at", "row"))), lambda x: x["row"])
    body = F.to_json(
        F.struct(
            F.count(F.lit(1)).alias("count"),
            F.lit(limit).alias("limit"),
            F.lit(offset).alias("offset"),
            gathered.alias(name),
        )
    )
    return numbered.agg(body.alias("body"), F.count(F.lit(1)).alias("count"))
