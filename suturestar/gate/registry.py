"""Every registered query: name -> Spark callable, and its oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from dateutil.relativedelta import relativedelta
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from suturestar.functions.lists import item_rows
from suturestar.functions.timekeys import date_key, full_years, time_key, wall_clock, weekday
from suturestar.gate import operational as op
from suturestar.gate import operational_sql, star_sql, storage, tables
from suturestar.operators import quality
from suturestar.operators.keys import add_keys
from suturestar.operators.lookup import Lookup, resolve_keys
from suturestar.operators.rows import one_per_key, only_new
from suturestar.operators.scd import scd2_merge, version_as_of, with_parent_key
from suturestar.operators.upsert import OPERATIONAL_LINKS, cascade_delete, upsert
from suturestar.plans import dims, etl, load, lookups, reports, views
from suturestar.plans.star import Star
from suturestar.plans.telemetry import flatten_telemetry, load_telemetry
from suturestar.session import scratch
from suturestar.sources import snapshots

Query = Callable[[SparkSession, str], DataFrame]
AS_OF, NOW = tables.AS_OF, tables.LOAD_TIME


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand over the same type."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _star(build: Callable) -> Query:
    return lambda spark, sf_dir: plain(build(tables.star(spark, sf_dir)))


def _recent(build: Callable, reach) -> Query:
    """A report that looks back `reach` from `as_of`; the reach also bounds the order scan."""
    return lambda spark, sf_dir: plain(build(tables.star(spark, sf_dir, AS_OF - reach), AS_OF))


def _tables(build: Callable) -> Query:
    return lambda spark, sf_dir: plain(build(op.OperationalTables(spark, sf_dir)))


VIEWS: dict[str, Query] = {name: _star(build) for name, build in views.WAREHOUSE_VIEWS.items()}

REPORTS: dict[str, Query] = {
    "q01_platform_metrics": _recent(reports.q01_platform_metrics, timedelta(days=30)),
    "q02_top_robots": _star(reports.q02_top_robots),
    "q03_monthly_trend": _recent(reports.q03_monthly_trend, relativedelta(months=12)),
    "q04_complications_by_type": _star(reports.q04_complications_by_type),
    "q05_outcomes_by_model": _star(reports.q05_outcomes_by_model),
    "q06_readmission_by_category": _star(reports.q06_readmission_by_category),
    "q07_top_surgeons": _star(reports.q07_top_surgeons),
    "q08_experience_bands": _star(reports.q08_experience_bands),
    "q09_facility_comparison": _star(reports.q09_facility_comparison),
    "q10_facility_efficiency": _recent(reports.q10_facility_efficiency, timedelta(days=90)),
    "q11_robot_health": _star(reports.q11_robot_health),
    "q12_day_of_week": _recent(reports.q12_day_of_week, timedelta(days=90)),
    "q13_time_of_day": _star(reports.q13_time_of_day),
    "q14_period_growth": _star(reports.q14_period_growth),
    "q15_age_cohorts": _star(reports.q15_age_cohorts),
}


def _procedure_detail(t: op.OperationalTables) -> DataFrame:
    return lookups.procedure_detail(t, "PROC-7").select(
        "procedure_id", "start_time", "robot_model", "facility_name", "outcome.outcome_id", "outcome.success_status"
    )


def _next_page(t: op.OperationalTables) -> DataFrame:
    """The page that a3_procedures skips to, reached from the token of the page before."""
    first = lookups.procedures(t, category="1-URGENT", limit=20)
    return lookups.procedures(t, category="1-URGENT", limit=50, after=lookups.last_of(first))


LOOKUPS: dict[str, Query] = {
    "op_robot_utilization": _tables(views.op_robot_utilization),
    "op_procedure_outcomes_summary": _tables(views.op_procedure_outcomes_summary),
    "op_maintenance_costs": _tables(views.op_maintenance_costs),
    "a1_robots": _tables(lambda t: lookups.robots(t, "FAC-003", "operational")),
    "a2_robot_detail": _tables(lambda t: lookups.robot_detail(t, "RBT-000000003")),
    "a3_procedures": _tables(lambda t: lookups.procedures(t, category="1-URGENT", limit=50, offset=20)),
    "a3_procedures_next": _tables(_next_page),
    "a4_procedure_detail": _tables(_procedure_detail),
    "a5_outcomes": _tables(
        lambda t: lookups.outcomes(t, "successful").drop("surgeon_notes", "created_at", "updated_at")
    ),
    "a6_utilization": _tables(lookups.robot_utilization),
    "a7_outcome_summary": _tables(lookups.outcome_summary),
    "a8_category_stats": _tables(lambda t: lookups.category_stats(t, NOW)),
    "a9_ingest_stats": _tables(lookups.ingest_stats),
    "c1_table_counts": _tables(lambda t: lookups.check_counts(t.all())),
    "c2_models": _tables(lookups.check_models),
    "c3_categories": _tables(lookups.check_categories),
    "c4_outcomes": _tables(lookups.check_outcomes),
    "c5_warehouse_counts": _star(lookups.warehouse_counts),
    "c6_fact_sanity": _star(lambda s: quality.fact_sanity(s.fact_procedures)),
    "c7_dashboard": _recent(lookups.dashboard, timedelta(days=30)),
    "c8_top_facilities": _star(lookups.top_facilities),
    "c9_utilization_in_year": _star(lambda s: lookups.utilization_in_year(s, 1999)),
    "vw_top_robots": _star(lookups.top_robots),
}


def val_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = op.OperationalTables(spark, sf_dir)
    ids = {
        "surgical_procedures": "procedure_id",
        "procedure_outcomes": "outcome_id",
        "surgical_robots": "robot_id",
        "robot_maintenance_logs": "maintenance_id",
    }
    parts = [
        quality.validate(t[name], quality.check_rules(name), [key]).withColumnRenamed(key, "id")
        for name, key in ids.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def val_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality.not_null_rules(["surgeon_id", "end_time", "duration_minutes", "patient_age", "status"])
    return quality.validate(op.surgical_procedures(spark, sf_dir), rules, ["procedure_id"])


def val_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_violations(tables.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def val_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = op.OperationalTables(spark, sf_dir)

    def check(child: str, table: str, key: str) -> DataFrame:
        bad = quality.foreign_key_violations(t[table].select(key, "robot_id"), t["surgical_robots"], "robot_id")
        return bad.select(F.lit(child).alias("child"), F.col(key).alias("id"), "robot_id")

    return check("procedure", "surgical_procedures", "procedure_id").unionByName(
        check("maintenance", "robot_maintenance_logs", "maintenance_id")
    )


# Rows that a check of the whole model sees twice, or parents that it misses, so that every rule is broken.
SEEDED = {
    "surgical_robots": "robot_model = 'Model-3'",
    "robot_maintenance_logs": "maintenance_type = 'emergency'",
    "surgical_procedures": "status = 'aborted'",
    "procedure_outcomes": "success_status = 'complicated'",
}


def val_unique_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every UNIQUE key of the operational model, over tables in which some rows occur twice."""
    t, parts = op.OperationalTables(spark, sf_dir), []
    for table, keys in quality.UNIQUE.items():
        twice = t[table].unionByName(t[table].filter(SEEDED[table]))
        for (key,) in keys:
            bad = quality.unique_violations(twice, [key])
            parts.append(bad.select(F.lit(table).alias("table_name"), F.lit(key).alias("key"), F.col(key).alias("value"), "copies"))
    return reduce(DataFrame.unionByName, parts)


def val_foreign_keys_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of the operational model, with some parents missing: broken child rows per missing parent."""
    t, parts = op.OperationalTables(spark, sf_dir), []
    for parent, child, key in OPERATIONAL_LINKS:
        there = t[parent].filter(f"not coalesce({SEEDED[parent]}, false)")
        bad = quality.foreign_key_violations(t[child], there, key).groupBy(F.col(key).alias("value"))
        parts.append(bad.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(child).alias("child"), F.lit(key).alias("key"), "value", "rows"))
    return reduce(DataFrame.unionByName, parts)


def _model_counts(spark: SparkSession, sf_dir: str, rules_of: Callable, spoilt: Callable) -> DataFrame:
    """Violations per table and rule, where `spoilt` gives the columns that seeded rows break."""
    t, parts = op.OperationalTables(spark, sf_dir), []
    for table, seed in SEEDED.items():
        seeded = t[table].withColumn("seeded", F.expr(f"coalesce({seed}, false)"))
        broken = {c: F.when(F.col("seeded"), bad).otherwise(F.col(c)) for c, bad in spoilt(table).items()}
        counts = quality.violation_counts(seeded.withColumns(broken), rules_of(table))
        parts.append(counts.select(F.lit(table).alias("table_name"), "rule", "violations"))
    return reduce(DataFrame.unionByName, parts)


def val_not_null_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every NOT NULL column of the operational model, with some rows that lack all of them."""
    required = quality.required_columns
    return _model_counts(
        spark, sf_dir, lambda table: quality.not_null_rules(required(table)), lambda table: {c: F.lit(None) for c in required(table)}
    )


def val_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every VARCHAR limit of the operational model, with some rows whose texts are one character too long."""
    limits = quality.LENGTHS
    return _model_counts(
        spark,
        sf_dir,
        lambda table: quality.length_rules(limits[table]),
        lambda table: {c: F.rpad(F.col(c), n + 1, "x") for c, n in limits[table].items()},
    )


def val_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, rejected = quality.split_required(op.telemetry_documents(spark, sf_dir))
    both = accepted.select(F.lit("accepted").alias("outcome")).unionByName(
        rejected.select(F.col("reason").alias("outcome"))
    )
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


def val_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions per robot after two merges, for the robots that no check objects to."""
    dim = _two_merges(spark, sf_dir)
    clean = dim.join(quality.version_overlaps(dim, "robot_id"), "robot_id", "left_anti")
    return clean.groupBy("robot_id").agg(F.count(F.lit(1)).alias("versions"))


QUALITY: dict[str, Query] = {
    f.__name__: f
    for f in (
        val_checks,
        val_not_null,
        val_not_null_model,
        val_lengths,
        val_unique,
        val_unique_model,
        val_foreign_keys,
        val_foreign_keys_model,
        val_required_fields,
        val_versions,
    )
}


def _two_merges(spark: SparkSession, sf_dir: str, mode: str = "changed") -> DataFrame:
    """The fleet after two runs, each written as a snapshot and read back, as the load does."""
    root = scratch(spark, "fleet")
    for fleet, day in ((op.first_fleet, op.FIRST_RUN), (op.second_fleet, op.SECOND_RUN)):
        state = scd2_merge(
            load.read_table(spark, root, "dim_robots"),
            fleet(spark, sf_dir),
            "robot_id",
            etl.TRACKED["dim_robots"],
            day,
            mode,
            surrogate="robot_key",
        )
        snapshots.write_snapshot(state, root, "dim_robots")
    return load.read_table(spark, root, "dim_robots")


def scd_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, and the second one again: it must add nothing, but refresh the counter."""
    again = scd2_merge(
        _two_merges(spark, sf_dir),
        op.second_fleet(spark, sf_dir),
        "robot_id",
        etl.TRACKED["dim_robots"],
        op.SECOND_RUN + timedelta(days=1),
    )
    return again.select(
        "robot_id", "status", "software_version", "effective_date", "expiration_date", "is_current", "total_procedures_count"
    )


def scd_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_merges(spark, sf_dir, "reference").select(
        "robot_id", "status", "effective_date", "expiration_date", "is_current"
    )


def scd_parent_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = op.surgical_robots(spark, sf_dir).select("robot_id", "facility_id")
    return with_parent_key(fleet, tables.dim_facilities(spark, sf_dir), "facility_id", "facility_key")


def scd_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_merges(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("versions"),
        F.min("robot_key").alias("first_key"),
        F.max("robot_key").alias("last_key"),
        F.count_distinct("robot_key").alias("distinct_keys"),
    )


def scd_version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    procs = op.surgical_procedures(spark, sf_dir).select("robot_id", F.to_date("start_time").alias("day"))
    joined = version_as_of(procs, _two_merges(spark, sf_dir), "robot_id", "day", ["status"])
    return joined.groupBy("robot_id", "status").agg(F.count(F.lit(1)).alias("procedures"))


def key_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = add_keys(tables.read(spark, sf_dir, "orders").select("o_orderkey"), "k", ["o_orderkey"], start=100)
    return keyed.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("k").alias("first_key"),
        F.max("k").alias("last_key"),
        F.count_distinct("k").alias("distinct_keys"),
        F.sum("o_orderkey").alias("order_sum"),
    )


def etl_extract_surgeons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.extract_surgeons(op.surgical_procedures(spark, sf_dir), AS_OF).drop("latest_start")


def etl_extract_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(etl.extract_robots(op.surgical_robots(spark, sf_dir), op.surgical_procedures(spark, sf_dir)))


def etl_extract_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.extract_facilities(op.surgical_robots(spark, sf_dir), dims.facility_seed(spark))


def etl_extract_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = op.OperationalTables(spark, sf_dir)
    return plain(
        etl.extract_procedures(
            t["surgical_procedures"],
            t["surgical_robots"],
            t["procedure_outcomes"],
            date(1998, 1, 1),
            date(1999, 1, 1),
        )
    )


def etl_normalise_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.normalise_outcomes(op.procedure_outcomes(spark, sf_dir)).select(
        "outcome_id", "success_status", "complications", "complication_level"
    )


def _keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    homes = op.surgical_robots(spark, sf_dir).select("robot_id", "facility_id")
    stage = (
        op.surgical_procedures(spark, sf_dir)
        .select("procedure_id", "robot_id", "surgeon_id")
        .join(homes, "robot_id", "left")
    )
    surgeons = tables.dim_surgeons(spark, sf_dir).withColumn(
        "surgeon_id", F.concat(F.lit("SURG-"), F.col("surgeon_key").cast("string"))
    )
    return resolve_keys(
        stage,
        {
            "robot": Lookup(tables.dim_robots(spark, sf_dir), "robot_id", "robot_key"),
            "surgeon": Lookup(surgeons, "surgeon_id", "surgeon_key"),
            "facility": Lookup(tables.dim_facilities(spark, sf_dir), "facility_id", "facility_key"),
        },
    )


def etl_resolve_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir)[0].select("procedure_id", "robot_key", "surgeon_key", "facility_key")


def etl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = F.array_join("unknown_members", ",").alias("members")
    return _keyed(spark, sf_dir)[1].groupBy(members).agg(F.count(F.lit(1)).alias("procedures"))


def etl_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, which repeat, against the orders loaded before 2000."""
    lines = tables.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    loaded = tables.read(spark, sf_dir, "orders").filter("o_orderdate < timestamp_ntz '2000-01-01 00:00:00'")
    unique = one_per_key(lines, ["l_orderkey", "l_linenumber"])
    return only_new(unique, loaded.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"])


def _samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return flatten_telemetry(storage.telemetry(spark, sf_dir))


SAMPLE_COLUMNS = (
    "sample_timestamp",
    "timestamp_key",
    "tool_type",
    "tool_active",
    "system_temperature",
    "network_latency_ms",
    "video_fps",
)


def etl_flatten_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        _samples(spark, sf_dir)[0].select("procedure_id", "arm_position_x", "arm_position_y", *SAMPLE_COLUMNS)
    )


def etl_telemetry_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = _samples(spark, sf_dir)[1]
    return refused.groupBy("reason").agg(F.count("document").alias("records"))


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    star = tables.star(spark, sf_dir)
    held = star.fact_procedure_telemetry.filter("tool_type = 'error'")
    return load_telemetry(_samples(spark, sf_dir)[0], star.completed(), held)


def etl_load_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_loaded(spark, sf_dir)[0].select("procedure_key", *SAMPLE_COLUMNS))


def etl_telemetry_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir)[1].groupBy("procedure_id").agg(F.count(F.lit(1)).alias("samples"))


def ups_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early orders as the table, every line as an update of the order of its number."""
    target = tables.read(spark, sf_dir, "orders").filter("o_orderdate < timestamp_ntz '1999-01-01 00:00:00'")
    base = target.selectExpr(
        "o_orderkey as id",
        "o_orderstatus as status",
        "o_totalprice as amount",
        "o_orderpriority as category",
        "cast(null as timestamp_ntz) as updated_at",
    )
    updates = tables.read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as id",
        "l_linestatus as status",
        "l_extendedprice as amount",
        "l_returnflag as category",
        "l_shipdate as at",
    )
    return upsert(base, updates, "id", ["status", "amount"], "at", stamp=("updated_at", NOW))


def del_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = op.OperationalTables(spark, sf_dir).all()
    doomed = t["surgical_robots"].filter("robot_model = 'Model-3'")
    return quality.row_counts(cascade_delete(t, "surgical_robots", "robot_id", doomed, OPERATIONAL_LINKS))


ETL: dict[str, Query] = {
    f.__name__: f
    for f in (
        key_dense,
        etl_extract_surgeons,
        etl_extract_robots,
        etl_extract_facilities,
        etl_extract_procedures,
        etl_normalise_outcomes,
        etl_resolve_keys,
        etl_rejects,
        etl_only_new,
        etl_flatten_telemetry,
        etl_telemetry_rejects,
        etl_load_telemetry,
        etl_telemetry_orphans,
        scd_changed,
        scd_reference,
        scd_parent_key,
        scd_keys,
        scd_version_as_of,
        ups_procedures,
        del_cascade,
    )
}


def dim_date_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar attributes of every day a line shipped."""
    days = tables.read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    return dims.date_attributes(days)


def dim_time_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry samples per minute of the day, with the minute's attributes."""
    per_minute = (
        tables.fact_telemetry(spark, sf_dir)
        .groupBy(F.col("timestamp_key").alias("time_key"))
        .agg(F.count(F.lit(1)).alias("samples"))
    )
    return dims.time_spine(spark).join(per_minute, "time_key")


def fn_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    today = F.lit(AS_OF)
    return tables.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(day, "yyyy-MM").alias("year_month"),
        date_key(day).alias("day_key"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("iso_week"),
        weekday(day).alias("dow"),
        F.datediff(today, day).alias("age_days"),
        F.add_months(day, 12).alias("next_year"),
        F.date_sub(day, 1).alias("day_before"),
        full_years(day, today).alias("full_years"),
    )


def fn_wall_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with Z, an offset or none: the clock as written."""
    docs = op.telemetry_documents(spark, sf_dir).select("event_id", wall_clock(F.col("timestamp")).alias("at"))
    return docs.filter(F.col("at").isNotNull()).select(
        "event_id", F.col("at").alias("sample_timestamp"), time_key(F.col("at")).alias("timestamp_key")
    )


def fn_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    complications = item_rows(op.procedure_outcomes(spark, sf_dir), "complications", ",", "item").select("item")
    actions = item_rows(op.robot_maintenance_logs(spark, sf_dir), "actions_taken", ";", "item").select("item")
    return complications.unionByName(actions).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


FUNCTIONS: dict[str, Query] = {
    f.__name__: f for f in (dim_date_attributes, dim_time_usage, fn_calendar, fn_wall_clock, fn_list_items)
}


def join_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that point at any version of a robot: before 2000 at the first, later at the newest."""
    versions = _two_merges(spark, sf_dir)
    fact = tables.fact_procedures(spark, sf_dir).select(
        F.concat(F.lit("RBT-"), F.lpad(F.col("robot_key").cast("string"), 9, "0")).alias("robot_id"),
        F.to_date(F.col("start_date_key").cast("string"), "yyyyMMdd").alias("day"),
        "duration_minutes",
        "complexity_score",
    )
    keyed = version_as_of(fact, versions, "robot_id", "day", ["robot_key"]).drop("robot_id")
    return plain(views.robot_utilization_all_versions(Star(dim_robots=versions, fact_procedures=keyed)))


JOINS: dict[str, Query] = {"join_all_versions": join_all_versions}


def queries() -> dict[str, Query]:
    return {**VIEWS, **REPORTS, **LOOKUPS, **QUALITY, **ETL, **FUNCTIONS, **JOINS, **storage.QUERIES}


def oracle_sql() -> dict[str, str]:
    star = {**star_sql.view_sql(), **star_sql.report_sql()}
    return {
        **star,
        **{name: star[like] for name, (like, _) in storage.LOADED.items()},
        **star_sql.check_sql(),
        **operational_sql.lookup_sql(),
        **operational_sql.quality_sql(),
        **operational_sql.etl_sql(),
        **operational_sql.function_sql(),
        **operational_sql.storage_sql(),
    }
