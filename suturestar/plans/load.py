"""The ordered batch: dimensions, then procedures, then telemetry."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from suturestar.operators.keys import add_sparse_keys, next_key
from suturestar.operators.scd import scd2_merge, with_parent_key
from suturestar.plans import dims, etl
from suturestar.plans.star import Star
from suturestar.plans.telemetry import not_held, split_tagged, tag_telemetry, with_procedure
from suturestar.schemas import TELEMETRY_STAGE, conform, nullable, schema_of
from suturestar.session import brief_shuffles
from suturestar.sources import ledger, snapshots, waiting, writers
from suturestar.sources.buckets import bucket_of, read_bucketed
from suturestar.sources.files import exists, remove

PROCEDURES, TELEMETRY = "fact_procedures", "fact_procedure_telemetry"
# Buckets of a fact's procedure key, fixed by its first load: each time partition gets that many files.  Few suit a small
# fleet, a large one wants as many as its cores; both facts need the same number to meet without a shuffle.
BUCKETS = 4
# A fact whose fullest bucket holds this many times its share is read as plain files, which Spark can split.
LOPSIDED, LOPSIDED_ROWS = 4, 1_000_000
# So is one whose buckets hold more rows than one task should sort: the number of buckets is fixed, the rows are not.
BUCKET_ROWS = 500_000
KEYS = {"dim_facilities": "facility_key", "dim_surgeons": "surgeon_key", "dim_robots": "robot_key"}
IDS = {"dim_facilities": "facility_id", "dim_surgeons": "surgeon_id", "dim_robots": "robot_id"}
ETL_TYPES = ("full", "dimensions", "procedures", "telemetry")
REPORT_DDL = "stage string, status string, inserted bigint, closed bigint, rejected bigint, message string"

SUCCESS, PARTIAL, FAILED = "SUCCESS", "PARTIAL_SUCCESS", "FAILED"


def _empty(spark: SparkSession, table: str) -> DataFrame:
    """No rows, in a form that the optimizer folds away together with the joins on it."""
    columns = [f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in schema_of(table).fields]
    return spark.range(1).where("false").selectExpr(*columns)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A star table below `root`; empty when nothing has been loaded."""
    if table in KEYS:
        found = snapshots.read_snapshot(spark, root, table)
        return _empty(spark, table) if found is None else found
    layout, path = writers.LAYOUTS[table], f"{root}/{table}"
    schema, state = nullable(schema_of(table)), ledger.last(spark, root, table)
    if state.get("buckets") and not _lopsided(state.get("loads")) and not _full(state):
        return read_bucketed(spark, path, schema, layout, state["buckets"])
    if not exists(spark, path):
        return _empty(spark, table).withColumn(layout.partition, F.lit(None).cast(layout.kind))
    # The declared schema also reads a folder that an append without rows has left, and no footers.
    return spark.read.schema(schema.add(layout.partition, layout.kind)).parquet(path)


def _lopsided(loads: list[int] | None) -> bool:
    """Whether one bucket, as of a procedure with a third of all samples, holds far more than its share."""
    return bool(loads) and sum(loads) >= LOPSIDED_ROWS and max(loads) * len(loads) > LOPSIDED * sum(loads)


def _full(state: dict) -> bool:
    """Whether a bucket, which one task reads and sorts, holds more than BUCKET_ROWS rows."""
    if state.get("loads"):
        return max(state["loads"]) > BUCKET_ROWS
    return (state.get("rows") or 0) > BUCKET_ROWS * state["buckets"]


def _first_key(held: ledger.Claim, existing: DataFrame, key: str) -> Column | int:
    """Above which key a load may number: the ledger's mark, or the table's own maximum where there is none to trust."""
    mark = held.before.get("key")
    return next_key(existing, key) if mark is None or not held.trusted else mark


def _buckets(spark: SparkSession, held: ledger.Claim, path: str, wanted: int) -> int:
    """The buckets of the fact's first load; 0 for files that were there before the ledger was."""
    if "buckets" in held.before:
        return held.before["buckets"]
    return 0 if exists(spark, path) else wanted


def calendar_of(spark: SparkSession, root: str) -> DataFrame:
    """dim_date for the default calendar and every month that holds a procedure."""
    months = read_table(spark, root, "fact_procedures").agg(F.min("start_date_key").alias("a"), F.max("start_date_key").alias("b")).first()
    first, last = dims.SPINE_START, dims.SPINE_START + timedelta(days=dims.SPINE_DAYS - 1)
    if months.a is not None:
        first = min(first, date(months.a // 10000, 1, 1))
        last = max(last, date(months.b // 10000, 12, 31))
    return dims.date_spine(spark, first, (last - first).days + 1)


def load_star(spark: SparkSession, root: str, first_day: date | None = None, n_days: int = dims.SPINE_DAYS) -> Star:
    """The star below `root`.  Its calendar covers what the fact holds, or `n_days` from `first_day` if that is given."""
    return Star(
        dim_date=lambda: calendar_of(spark, root) if first_day is None else dims.date_spine(spark, first_day, n_days),
        dim_time=lambda: dims.time_spine(spark),
        dim_facilities=lambda: read_table(spark, root, "dim_facilities"),
        dim_surgeons=lambda: read_table(spark, root, "dim_surgeons"),
        dim_robots=lambda: read_table(spark, root, "dim_robots"),
        fact_procedures=lambda: read_table(spark, root, "fact_procedures"),
        fact_procedure_telemetry=lambda: read_table(spark, root, "fact_procedure_telemetry"),
    )


def _merge_dimension(
    spark: SparkSession, root: str, table: str, snapshot: DataFrame, as_of: date, mode: str, order: tuple[str, ...] = ()
) -> tuple[int, int]:
    """Write the dimension's next snapshot; (inserted, closed) are observed by that same write."""
    with ledger.writing(spark, root, table) as held:
        merged = scd2_merge(
            read_table(spark, root, table),
            snapshot,
            IDS[table],
            etl.TRACKED[table],
            as_of,
            mode,
            surrogate=KEYS[table],
            order=order,
            keep_change=True,
        )
        seen = Observation(table)
        counted = merged.observe(
            seen,
            F.count_if(F.col("change").isin("new", "changed")).alias("inserted"),
            F.count_if(F.col("change") == "closed").alias("closed"),
        )
        snapshots.save(counted.drop("change"), root, held)
    return seen.get["inserted"], seen.get["closed"]


def load_dimensions(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, as_of: date, robot_mode: str = "changed"
) -> list[tuple]:
    """Facilities before robots, which carry the facility's key."""
    robots, procedures = tables["surgical_robots"], tables["surgical_procedures"]
    report = []
    facilities = etl.extract_facilities(robots, dims.facility_seed(spark))
    report.append(("facilities", *_merge_dimension(spark, root, "dim_facilities", facilities, as_of, "changed")))
    surgeons = etl.extract_surgeons(procedures, as_of)
    counts = _merge_dimension(spark, root, "dim_surgeons", surgeons, as_of, "changed", ("latest_start",))
    report.append(("surgeons", *counts))
    fleet = with_parent_key(
        etl.extract_robots(robots, procedures), read_table(spark, root, "dim_facilities"), "facility_id", "facility_key"
    )
    report.append(("robots", *_merge_dimension(spark, root, "dim_robots", fleet, as_of, robot_mode)))
    return [(stage, SUCCESS, inserted, closed, 0, "") for stage, inserted, closed in report]


def _cuts(spark: SparkSession, folder: str) -> Callable[[DataFrame], DataFrame]:
    """Writes rows below `folder` and reads them back; what it wrote before is removed.

    The shuffle files of an execution lie on disk until its end: in pieces a load holds those of one step.
    """
    written: list[str] = []

    def cut(rows: DataFrame) -> DataFrame:
        path = f"{folder}/{len(written)}"
        with brief_shuffles(spark):
            rows.write.parquet(path)
        if written:
            remove(spark, written[-1])
        written.append(path)
        return spark.read.schema(rows.schema).parquet(path)

    return cut


def load_procedures(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    start: date | datetime,
    end: date | datetime,
    now: datetime | None = None,
    buckets: int = BUCKETS,
) -> tuple:
    """Append the window's procedures that the fact does not hold; unknown members are counted as rejected.

    Keys go on from the ledger's mark, so the fact is read for the window's own ids only.
    """
    stage = etl.extract_procedures(
        tables["surgical_procedures"], tables["surgical_robots"], tables["procedure_outcomes"], start, end
    )
    path, staged = f"{root}/{PROCEDURES}", f"{root}/staged_procedures/{uuid.uuid4().hex}"
    cut = _cuts(spark, staged)
    with ledger.writing(spark, root, PROCEDURES) as held:
        existing = read_table(spark, root, PROCEDURES)
        if exists(spark, path):
            # What the fact holds is found by the stage's ids and then taken from the stage: two reads of one extract.
            stage = cut(stage)
        keyed, _ = etl.stage_facts(stage, load_star(spark, root), existing, cut)
        first = _first_key(held, existing, "procedure_key")
        numbered = cut(add_sparse_keys(cut(keyed), "procedure_key", ["procedure_id"], start=first))
        unknown = (F.col("robot_key") < 0) | (F.col("surgeon_key") < 0) | (F.col("facility_key") < 0)
        seen = Observation(PROCEDURES)
        counts = (F.count(F.lit(1)).alias("inserted"), F.count_if(unknown).alias("rejected"), F.max("procedure_key").alias("top"))
        held.values["buckets"] = _buckets(spark, held, path, buckets)
        writers.append_fact(
            PROCEDURES, conform(numbered, PROCEDURES, now), path, lambda df: df.observe(seen, *counts), held.values["buckets"]
        )
        _mark(held, first, seen.get["top"])
        # Keys are spread evenly over the buckets, so the rows of all tell those of one.
        held.values["rows"] = (held.before.get("rows") or 0) + seen.get["inserted"]
    remove(spark, staged)
    return ("procedures", SUCCESS, seen.get["inserted"], 0, seen.get["rejected"], "")


def _mark(held: ledger.Claim, first: Column | int, top: int | None) -> None:
    """The largest key given out; without new rows and without a known mark the next load looks again."""
    held.values["key"] = top if top is not None else first if isinstance(first, int) else None


def waiting_samples(spark: SparkSession, root: str) -> DataFrame | None:
    """Samples whose procedure has not come; None when none ever waited."""
    if not waiting.any_waiting(spark, root):
        return None
    known = read_table(spark, root, PROCEDURES).select("procedure_id")
    return waiting.stored(spark, root).join(known, "procedure_id", "left_anti").drop("bucket")


def append_samples(
    spark: SparkSession,
    samples: DataFrame,
    root: str,
    now: datetime | None = None,
    buckets: int = BUCKETS,
    patience: float = 0.0,
) -> tuple[int, int]:
    """Append the samples that the fact does not hold; (inserted, orphans of this batch).

    Samples whose procedure is missing wait, as telemetry usually comes before its procedure; those whose procedure
    has come since the last batch are appended with this one.  One join tells found from missing samples, and only the days
    of found ones are looked at in the fact.  A replayed batch adds nothing to the fact.  While another load holds the
    fact, this one waits for `patience` seconds.
    """
    path, matched = f"{root}/{TELEMETRY}", f"{root}/matched_telemetry/{uuid.uuid4().hex}"
    with ledger.writing(spark, root, TELEMETRY, patience) as held:
        mark, before = ledger.last(spark, root, PROCEDURES).get("key"), held.before.get("matched") or 0
        procedures, existing = read_table(spark, root, PROCEDURES), read_table(spark, root, TELEMETRY)
        both = samples.withColumn("own", F.lit(True))
        if waiting.any_waiting(spark, root) and (mark is None or mark > before):
            back = waiting.answered(spark, root, procedures.filter(F.col("procedure_key") > before))
            both = both.unionByName(back.withColumn("own", F.lit(False)))
        with_procedure(both, procedures).write.parquet(matched)
        batch = spark.read.parquet(matched)

        found = batch.filter("procedure_key IS NOT NULL").drop("own")
        first = _first_key(held, existing, "telemetry_key")
        numbered = add_sparse_keys(not_held(found, existing), "telemetry_key", ["procedure_key", "sample_timestamp"], start=first)
        seen = Observation(TELEMETRY)
        counts = (F.count(F.lit(1)).alias("inserted"), F.max("telemetry_key").alias("top"))
        n = held.values["buckets"] = _buckets(spark, held, path, buckets)
        writers.append_fact(TELEMETRY, conform(numbered, TELEMETRY, now), path, lambda df: df.observe(seen, *counts), n)
        _mark(held, first, seen.get["top"])
        if n:
            offered = {r.bucket: r["count"] for r in found.groupBy(bucket_of("procedure_key", n).alias("bucket")).count().collect()}
            held.values["loads"] = [a + offered.get(b, 0) for b, a in enumerate(held.before.get("loads") or [0] * n)]

        missing = Observation("waiting")
        orphans = batch.filter("own AND procedure_key IS NULL").drop("own", "procedure_key")
        waiting.keep(orphans, root, (now or datetime.now()).date(), lambda df: df.observe(missing, F.count(F.lit(1)).alias("rows")))
        held.values["matched"] = mark
    remove(spark, matched)
    return seen.get["inserted"], missing.get["rows"]


def expire_waiting(spark: SparkSession, root: str, before: date) -> tuple:
    """Give up on samples that arrived before a day and still have no procedure; they count as rejected."""
    with ledger.writing(spark, root, TELEMETRY):
        gone = waiting.expire(spark, root, before, read_table(spark, root, PROCEDURES))
    return ("expired_telemetry", SUCCESS, 0, 0, gone, "")


def stage_samples(spark: SparkSession, raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(samples, refused), written once as columns so that the steps of the load do not parse JSON again."""
    tag_telemetry(raw).write.mode("overwrite").parquet(path)
    return split_tagged(spark.read.parquet(path))


def load_samples(spark: SparkSession, raw: DataFrame, root: str, now: datetime | None = None, buckets: int = BUCKETS) -> tuple:
    """Stage, append what is new, and count orphans and refused records as rejected.

    The staged batch stays below `root`/staged_telemetry with every refused document.
    """
    samples, refused = stage_samples(spark, raw, f"{root}/staged_telemetry/{uuid.uuid4().hex}")
    inserted, orphans = append_samples(spark, samples, root, now, buckets)
    return ("telemetry", SUCCESS, inserted, 0, orphans + refused.count(), "")


def retry_orphans(spark: SparkSession, root: str, now: datetime | None = None, buckets: int = BUCKETS) -> tuple:
    """Append the waiting samples whose procedure has come."""
    nothing = spark.range(1).where("false").selectExpr(*[f"cast(null as {kind}) as {name}" for name, kind in TELEMETRY_STAGE.items()])
    inserted, _ = append_samples(spark, nothing, root, now, buckets)
    return ("waiting_telemetry", SUCCESS, inserted, 0, 0, "")


def run_pipeline(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    etl_type: str = "full",
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    as_of: date | None = None,
    telemetry: DataFrame | None = None,
    robot_mode: str = "changed",
    now: datetime | None = None,
    buckets: int = BUCKETS,
    max_wait_days: int | None = None,
) -> DataFrame:
    """Run the stages of `etl_type` in order and report each one, then the overall status.

    With `max_wait_days`, samples that have waited longer for their procedure are given up.

    A failed dimension or procedure load stops the run (FAILED); a failed telemetry load leaves what
    came before (PARTIAL_SUCCESS).  Loads skip what they find loaded, so a run can be repeated.
    """
    if etl_type not in ETL_TYPES:
        raise ValueError(f"unknown etl_type {etl_type!r}")
    as_of = as_of or date.today()
    start, end = etl.window_of(start, end, as_of)
    stages: list[tuple[str, Callable[[], list[tuple]], str]] = []
    if etl_type in ("full", "dimensions"):
        stages.append(("dimensions", lambda: load_dimensions(spark, tables, root, as_of, robot_mode), FAILED))
    if etl_type in ("full", "procedures"):
        stages.append(("procedures", lambda: [load_procedures(spark, tables, root, start, end, now, buckets)], FAILED))
    if etl_type in ("full", "telemetry") and telemetry is not None:
        stages.append(("telemetry", lambda: [load_samples(spark, telemetry, root, now, buckets)], PARTIAL))
    elif etl_type in ("full", "procedures") and waiting.any_waiting(spark, root):
        stages.append(("waiting_telemetry", lambda: [retry_orphans(spark, root, now, buckets)], PARTIAL))
    if max_wait_days is not None and etl_type in ("full", "telemetry"):
        oldest = as_of - timedelta(days=max_wait_days)
        stages.append(("expired_telemetry", lambda: [expire_waiting(spark, root, oldest)], PARTIAL))

    report, status = [], SUCCESS
    for name, run, on_error in stages:
        try:
            with brief_shuffles(spark):
                report += run()
        except Exception as e:  # noqa: BLE001 - the report carries it
            report.append((name, "FAILED", 0, 0, 0, str(e)))
            status = on_error
            break
    total = [sum(row[i] for row in report) for i in (2, 3, 4)]
    report.append(("total", status, *total, ""))
    return spark.createDataFrame(report, REPORT_DDL)
