"""Registered queries that write and read back: sources, sinks, streams and the whole load.

Each call writes below a fresh folder of the shared folder, so runs do not meet.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.gate import operational as op
from suturestar.gate import tables
from suturestar.plans import etl, load, lookups, reports, views
from suturestar.plans.telemetry import STAGE_COLUMNS, flatten_telemetry
from suturestar.schemas import TELEMETRY_STAGE_DDL, UNKNOWN_KEY, conform
from suturestar.session import brief_shuffles, scratch
from suturestar.sources import raw, readers, writers
from suturestar.sources.files import remove
from suturestar.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
ALL_TIME = (date(1900, 1, 1), date(2100, 1, 1))
# Compressed files cannot be split, so they hold few documents.
SMALL_FILES = {"compression": "gzip", "maxRecordsPerFile": 250_000}


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as telemetry documents, through JSON files."""
    path = scratch(spark, "documents")
    op.write_documents(spark, sf_dir, path)
    return readers.read_telemetry(spark, f"{path}/telemetry")


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def src_csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    op.surgical_procedures(spark, sf_dir).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
    ).csv(path)
    return _doubles(readers.read_csv_table(spark, path, "surgical_procedures"))


def _operational(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """All operational tables written, read back, and three of them joined."""
    root = scratch(spark, "operational")
    for name, df in op.OperationalTables(spark, sf_dir).all().items():
        if fmt == "csv":
            options = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
            df.write.options(**options).csv(f"{root}/{name}.csv")
        else:
            df.write.format(fmt).save(f"{root}/{name}")
    t = readers.read_operational(spark, root, fmt)
    fleet = t["surgical_robots"].select("robot_id", "robot_model", "installation_date", "firmware_version")
    results = t["procedure_outcomes"].select("procedure_id", "success_status", "follow_up_required")
    found = t["surgical_procedures"].select("procedure_id", "start_time", "robot_id").join(fleet, "robot_id")
    return found.join(results, "procedure_id", "left").drop("robot_id")


def src_operational_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _operational(spark, sf_dir, "parquet")


def src_operational_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _operational(spark, sf_dir, "csv")


def snk_staged_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = op.OperationalTables(spark, sf_dir)
    stage = etl.extract_procedures(
        t["surgical_procedures"], t["surgical_robots"], t["procedure_outcomes"], *ALL_TIME
    )
    path = writers.write_staged_csv(stage, scratch(spark, "stage"), "20010801", "procedures")
    return _doubles(readers.read_staged_csv(spark, path, stage.schema))


def src_telemetry_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).groupBy("procedure_id", "tool_type").agg(F.count(F.lit(1)).alias("documents"))


def snk_telemetry_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples, _ = flatten_telemetry(telemetry(spark, sf_dir))
    path = writers.write_telemetry_stage(samples, scratch(spark, "stage"), "20010801")
    staged = readers.read_staged_csv(spark, path, TELEMETRY_STAGE_DDL)
    return _doubles(staged)


def snk_fact_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written in month partitions; the months are read from the folders."""
    path = scratch(spark, "fact")
    writers.append_procedures(conform(tables.fact_procedures(spark, sf_dir), "fact_procedures", tables.LOAD_TIME), path)
    return (
        spark.read.parquet(path)
        .groupBy("start_month")
        .agg(F.count(F.lit(1)).alias("procedures"), F.sum("duration_minutes").alias("minutes"))
    )


def snk_land_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "landing")
    records = tables.read(spark, sf_dir, "events").withColumn("type", F.expr("nullif(event_type, 'error')"))
    writers.land_batch(records, f"{path}/batch")
    return spark.read.json(f"{path}/batch").groupBy("type").agg(F.count(F.lit(1)).alias("records"))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "ingest")
    op.write_documents(spark, sf_dir, path)
    jobs.stream_ingest(spark, f"{path}/telemetry", f"{path}/landed", f"{path}/checkpoint").awaitTermination()
    return f"{path}/landed"


def snk_land_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted records landed by day."""
    landed = spark.read.json(f"{_landed(spark, sf_dir)}/telemetry")
    return landed.groupBy("sample_date").agg(F.count(F.lit(1)).alias("records"))


def _landed_raw(spark: SparkSession, sf_dir: str) -> str:
    """Documents with a field that no schema names (`event_id`), landed as VARIANT; some lines broke off."""
    path = scratch(spark, "raw")
    docs = op.telemetry_documents(spark, sf_dir)
    line = F.to_json(F.struct(*docs.columns))
    broken = F.when(F.expr("pmod(event_id, 40) = 7"), F.left(line, F.lit(30))).otherwise(line)
    docs.select(broken.alias("value")).write.text(f"{path}/lines")
    jobs.stream_raw(spark, f"{path}/lines", f"{path}/landed", f"{path}/checkpoint", names="*.txt").awaitTermination()
    return f"{path}/landed"


def src_raw_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records and their undeclared field per procedure and day, and the number of refused lines."""
    landed = _landed_raw(spark, sf_dir)
    by = [raw.field("$.procedure_id", "string").alias("procedure_id"), F.col("sample_date")]
    counts = [F.count(F.lit(1)).alias("records"), F.sum(raw.field("$.event_id", "bigint")).alias("event_ids")]
    records = raw.read_raw(spark, landed).groupBy(*by).agg(*counts)
    refused = spark.read.schema("reason string, document string").json(f"{landed}/rejected")
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("procedure_id", "string"), ("sample_date", "date"))]
    lines = refused.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("records"))
    return records.withColumn("outcome", F.lit("landed")).unionByName(
        lines.select("*", *none, F.lit(None).cast("bigint").alias("event_ids"))
    )


def etl_raw_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed samples cut from the VARIANT records, with the undeclared field left to them."""
    samples, _ = flatten_telemetry(raw.documents(raw.read_raw(spark, _landed_raw(spark, sf_dir))))
    return _doubles(samples)


def str_valid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir)
    sides = [
        spark.read.schema("procedure_id string")
        .option("recursiveFileLookup", True)
        .json(f"{path}/{side}")
        .select(F.lit(side).alias("side"))
        for side in ("telemetry", "rejected")
    ]
    return sides[0].unionByName(sides[1]).groupBy("side").agg(F.count(F.lit(1)).alias("records"))


def snk_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = lookups.procedures(op.OperationalTables(spark, sf_dir), limit=25, offset=5)
    body = writers.envelope(page, 25, 5, [F.desc("start_time"), "procedure_id"], "procedures")
    parsed = F.from_json(
        "body", "count bigint, limit int, offset int, procedures array<struct<procedure_id: string>>"
    ).alias("b")
    return body.select(parsed).select(
        "b.count",
        "b.limit",
        "b.offset",
        F.col("b.procedures")[0]["procedure_id"].alias("first_id"),
        F.element_at("b.procedures", -1)["procedure_id"].alias("last_id"),
    )


def _load_facts(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Every procedure, keyed by its order number, as the fact the telemetry looks up."""
    fact = op.surgical_procedures(spark, sf_dir).selectExpr(
        "cast(substr(procedure_id, 6) as bigint) as procedure_key",
        "procedure_id",
        f"{UNKNOWN_KEY} as robot_key",
        f"{UNKNOWN_KEY} as surgeon_key",
        f"{UNKNOWN_KEY} as facility_key",
        f"{tables.date_key('start_time')} as start_date_key",
        f"{tables.time_key('start_time')} as start_time_key",
        "procedure_type",
        "procedure_category",
    )
    writers.append_procedures(conform(fact, "fact_procedures", tables.LOAD_TIME), f"{root}/fact_procedures")


def str_telemetry_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents arrive twice, the second time with the first still in the source; samples load once."""
    root = scratch(spark, "stream")
    _load_facts(spark, sf_dir, root)
    for _ in range(2):
        op.telemetry_documents(spark, sf_dir).drop("event_id").write.mode("append").json(f"{root}/telemetry")
        jobs.stream_telemetry(spark, f"{root}/telemetry", root, f"{root}/checkpoint").awaitTermination()
    samples = load.read_table(spark, root, "fact_procedure_telemetry")
    names = load.read_table(spark, root, "fact_procedures").select("procedure_key", "procedure_id")
    per_key = samples.groupBy("procedure_key").agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum("network_latency_ms").alias("latency"),
        F.min("sample_timestamp").alias("first_sample"),
        F.max("sample_timestamp").alias("last_sample"),
    )
    return per_key.join(names, "procedure_key").drop("procedure_key")


def str_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State-based suppression of documents that arrive twice within the delay."""
    path = scratch(spark, "dedup")
    for _ in range(2):
        op.telemetry_documents(spark, sf_dir).drop("event_id").write.mode("append").json(f"{path}/telemetry")
    samples, _ = flatten_telemetry(jobs.telemetry_files(spark, f"{path}/telemetry"))
    unique = jobs.suppress_duplicates(samples.select(*STAGE_COLUMNS), "60 days")
    unique.writeStream.format("parquet").option("path", f"{path}/out").option(
        "checkpointLocation", f"{path}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(TELEMETRY_STAGE_DDL).parquet(f"{path}/out")
    return out.groupBy("procedure_id").agg(F.count(F.lit(1)).alias("samples"))


def str_procedure_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as procedure records: the first of an order inserts it, later ones update three columns."""
    path = scratch(spark, "procedures")
    tables.read(spark, sf_dir, "lineitem").selectExpr(
        f"{tables.procedure_id('l_orderkey')} as procedure_id",
        "l_linestatus as status",
        "cast(l_quantity as int) as duration_minutes",
        "l_returnflag as procedure_category",
        "l_shipdate as recorded_at",
    ).write.json(f"{path}/in")
    jobs.stream_procedures(spark, f"{path}/in", f"{path}/log", f"{path}/checkpoint").awaitTermination()
    return jobs.current_procedures(spark, f"{path}/log").select(
        "procedure_id", "status", "duration_minutes", "procedure_category"
    )


def full_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions, procedures and telemetry into an empty star, and once more: the repeat adds nothing."""
    root = scratch(spark, "star")
    t = op.OperationalTables(spark, sf_dir).all()
    documents = telemetry(spark, sf_dir)

    def run() -> DataFrame:
        return load.run_pipeline(
            spark, t, root, "full", *ALL_TIME, as_of=tables.AS_OF, telemetry=documents, now=tables.LOAD_TIME
        )

    first = run().filter("stage <> 'total'")
    again = run().filter("stage = 'total'").withColumn("stage", F.lit("repeated"))
    return first.unionByName(again).drop("message")


_stars: dict[tuple[str, str], str] = {}


def loaded_star(spark: SparkSession, sf_dir: str):
    """The star that a full load of the operational tables has written, read back; loaded once a session."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _stars:
        root, source = scratch(spark, "star"), scratch(spark, "source")
        t = op.OperationalTables(spark, sf_dir).all()
        with brief_shuffles(spark):
            # Built from lineitem, and read by several steps.
            for name in ("surgical_procedures", "procedure_outcomes"):
                t[name].write.parquet(f"{source}/{name}")
                t[name] = spark.read.parquet(f"{source}/{name}")
        op.write_documents(spark, sf_dir, source, **SMALL_FILES)
        documents = readers.read_telemetry(spark, f"{source}/telemetry")
        report = load.run_pipeline(
            spark, t, root, "full", *ALL_TIME, as_of=tables.AS_OF, telemetry=documents, now=tables.LOAD_TIME
        )
        remove(spark, source)
        problem = report.filter("status = 'FAILED'").first()
        if problem is not None:
            raise RuntimeError(problem.message)
        _stars[at] = root
    return load.load_star(spark, _stars[at])


def _on_loaded(build: Callable) -> Query:
    return lambda spark, sf_dir: _doubles(build(loaded_star(spark, sf_dir)))


# Views and reports on what the load wrote; their SQL is that of the adapter's star.
LOADED: dict[str, tuple[str, Query]] = {
    "star_v8": ("vw_daily_procedure_volume", _on_loaded(views.vw_daily_procedure_volume)),
    "star_v11": ("vw_telemetry_system_health", _on_loaded(views.vw_telemetry_system_health)),
    "star_q11": ("q11_robot_health", _on_loaded(reports.q11_robot_health)),
    "star_v9": ("vw_procedures_by_time_of_day", _on_loaded(views.vw_procedures_by_time_of_day)),
    "star_q03": ("q03_monthly_trend", _on_loaded(lambda s: reports.q03_monthly_trend(s, tables.AS_OF))),
    "star_q06": ("q06_readmission_by_category", _on_loaded(reports.q06_readmission_by_category)),
    "star_q12": ("q12_day_of_week", _on_loaded(lambda s: reports.q12_day_of_week(s, tables.AS_OF))),
    "star_q13": ("q13_time_of_day", _on_loaded(reports.q13_time_of_day)),
    "star_q14": ("q14_period_growth", _on_loaded(reports.q14_period_growth)),
}

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        src_csv_table,
        src_operational_parquet,
        src_operational_csv,
        snk_staged_csv,
        src_telemetry_json,
        snk_telemetry_stage,
        snk_fact_append,
        snk_land_batch,
        snk_land_stream,
        src_raw_variant,
        etl_raw_flatten,
        snk_envelope,
        str_telemetry_intake,
        str_deduplicated,
        str_valid_split,
        str_procedure_upsert,
        full_load_report,
    )
} | {name: query for name, (_, query) in LOADED.items()}
