"""The warehouse views (star) and the operational views.

Shape shared by the star views: the fact is reduced to one row per foreign key first, and only that
result meets robots, surgeons or facilities, whose size grows with the business.  No join carries a
broadcast hint; Spark broadcasts what it measures as small and otherwise sorts, merges and splits
skewed partitions.  Views return unordered rows; the caller sorts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suturestar.functions.measures import (
    Measure,
    average,
    bucket,
    combine,
    distinct,
    groups,
    high,
    hits,
    hours,
    low,
    partials,
    rate,
    rows,
    span_days,
    summarise,
)
from suturestar.plans.star import Star

ROBOT_COLUMNS = ("robot_key", "robot_id", "robot_serial_number", "robot_model", "facility_key")


def successful() -> Column:
    return F.col("success_status") == "Successful"


def no_complication() -> Column:
    return F.col("complication_level") == "None"


def serious() -> Column:
    return F.col("complication_level").isin("Moderate", "Severe")


def readmitted() -> Column:
    return F.col("readmission_30day")


def not_readmitted() -> Column:
    return ~F.coalesce(F.col("readmission_30day"), F.lit(False))


def with_start_date(star: Star, fact: DataFrame, *columns: str) -> DataFrame:
    """`fact` joined to the calendar day it starts on."""
    dates = star.dim_date.select(F.col("date_key").alias("start_date_key"), *columns)
    return fact.join(dates, "start_date_key")


def robots_at_facilities(star: Star, *facility_columns: str, facility_current: bool = True) -> DataFrame:
    """Current robots with their home facility (one row per robot_key)."""
    facilities = star.current("dim_facilities") if facility_current else star.dim_facilities
    return (
        star.current("dim_robots")
        .select(*ROBOT_COLUMNS)
        .join(facilities.select("facility_key", *facility_columns), "facility_key")
    )


def vw_robot_utilization(star: Star) -> DataFrame:
    by = ["robot_id", "robot_serial_number", "robot_model", "facility_name", "city", "state"]
    measures = [
        rows("total_procedures"),
        hours("total_operating_hours", "duration_minutes"),
        average("avg_procedure_duration_minutes", "duration_minutes"),
        average("avg_complexity", "complexity_score"),
        low("first_procedure_date", "date"),
        high("last_procedure_date", "date"),
    ]
    per_robot = partials(with_start_date(star, star.fact_procedures, "date"), ["robot_key"], measures)
    robots = robots_at_facilities(star, "facility_name", "city", "state")
    return combine(per_robot.join(robots, "robot_key"), by, measures).withColumns(
        {
            "days_in_operation": span_days("first_procedure_date", "last_procedure_date"),
            "procedures_per_day": F.col("total_procedures").cast("double")
            / F.nullif(span_days("first_procedure_date", "last_procedure_date"), F.lit(0)),
        }
    )


def vw_robot_utilization_monthly(star: Star) -> DataFrame:
    by = ["robot_id", "robot_model", "facility_name", "year", "month", "month_name"]
    measures = [
        rows("procedure_count"),
        hours("operating_hours", "duration_minutes"),
        average("avg_duration", "duration_minutes"),
        average("avg_complexity", "complexity_score"),
    ]
    dated = with_start_date(star, star.fact_procedures, "year", "month", "month_name")
    per_month = partials(dated, ["robot_key", "year", "month", "month_name"], measures)
    robots = robots_at_facilities(star, "facility_name", facility_current=False)
    return combine(per_month.join(robots, "robot_key"), by, measures)


def vw_procedure_outcomes(star: Star) -> DataFrame:
    return summarise(
        star.completed(),
        ["procedure_type", "procedure_category"],
        [
            rows("total_procedures"),
            hits("successful_count", successful()),
            rate("success_rate", successful()),
            average("avg_duration_minutes", "duration_minutes"),
            average("avg_blood_loss_ml", "blood_loss_ml"),
            average("avg_hospital_stay_days", "hospital_stay_days"),
            average("avg_satisfaction_score", "patient_satisfaction_score"),
            hits("complication_count", serious()),
            hits("readmission_count", readmitted()),
            rate("readmission_rate", readmitted()),
        ],
    )


def vw_outcomes_by_robot_model(star: Star) -> DataFrame:
    measures = [
        rows("total_procedures"),
        average("avg_complexity", "complexity_score"),
        rate("success_rate", successful()),
        average("avg_duration", "duration_minutes"),
        average("avg_blood_loss", "blood_loss_ml"),
        average("avg_satisfaction", "patient_satisfaction_score"),
        rate("no_complication_rate", no_complication()),
    ]
    return by_robot(star, star.completed(), ["robot_model", "manufacturer"], measures)


def by_robot(star: Star, fact: DataFrame, by: list[str], measures: list[Measure]) -> DataFrame:
    """Fact per robot_key, then merged by attributes of the current robots."""
    robots = star.current("dim_robots").select("robot_key", *by)
    return combine(partials(fact, ["robot_key"], measures).join(robots, "robot_key"), by, measures)


def by_surgeon(star: Star, by: list[str], measures: list[Measure], *fact_keys: str) -> DataFrame:
    """Completed procedures per surgeon_key (and fact keys), merged by current surgeons' attributes."""
    attributes = [c for c in by if c not in fact_keys]
    surgeons = star.current("dim_surgeons").select("surgeon_key", *attributes)
    per_surgeon = partials(star.completed(), ["surgeon_key", *fact_keys], measures)
    return combine(per_surgeon.join(surgeons, "surgeon_key"), by, measures)


def vw_surgeon_performance(star: Star) -> DataFrame:
    return by_surgeon(
        star,
        ["surgeon_id", "surgeon_name", "specialization", "years_experience"],
        [
            rows("total_procedures"),
            average("avg_complexity_score", "complexity_score"),
            rate("success_rate", successful()),
            average("avg_procedure_duration", "duration_minutes"),
            average("avg_blood_loss", "blood_loss_ml"),
            average("avg_patient_satisfaction", "patient_satisfaction_score"),
            rate("no_complication_rate", no_complication()),
            rate("no_readmission_rate", not_readmitted()),
        ],
    )


def vw_surgeon_procedure_categories(star: Star) -> DataFrame:
    """By surgeon name only, so namesakes merge."""
    return by_surgeon(
        star,
        ["surgeon_name", "procedure_category"],
        [
            rows("procedure_count"),
            average("avg_complexity", "complexity_score"),
            average("avg_duration", "duration_minutes"),
            rate("success_rate", successful()),
        ],
        "procedure_category",
    )


def vw_facility_performance(star: Star) -> DataFrame:
    """By the robot's home facility; distinct robots and surgeons are counted on (robot, surgeon) pairs."""
    attributes = ["facility_id", "facility_name", "city", "state", "facility_type"]
    measures = [
        distinct("robot_count", "robot_key"),
        rows("total_procedures"),
        distinct("surgeon_count", "surgeon_key"),
        average("avg_procedure_duration", "duration_minutes"),
        rate("success_rate", successful()),
        average("avg_patient_satisfaction", "patient_satisfaction_score"),
        average("avg_hospital_stay", "hospital_stay_days"),
    ]
    pairs = partials(star.completed(), ["robot_key", "surgeon_key"], measures)
    robots = robots_at_facilities(star, *attributes)
    return combine(pairs.join(robots, "robot_key"), attributes, measures)


def vw_daily_procedure_volume(star: Star) -> DataFrame:
    by = ["date", "year", "month", "day_name", "is_weekend"]
    measures = [
        rows("procedure_count"),
        average("avg_duration", "duration_minutes"),
        hours("total_operating_hours", "duration_minutes"),
    ]
    per_day = partials(star.completed(), ["start_date_key"], measures)
    return combine(with_start_date(star, per_day, *by), by, measures)


def vw_procedures_by_time_of_day(star: Star) -> DataFrame:
    return by_clock(
        star,
        ["time_of_day", "business_hours"],
        [
            rows("procedure_count"),
            average("avg_duration", "duration_minutes"),
            average("avg_complexity", "complexity_score"),
            rate("success_rate", successful()),
        ],
    )


def by_clock(star: Star, by: list[str], measures: list[Measure]) -> DataFrame:
    """Completed procedures per start minute, merged by attributes of dim_time."""
    clock = star.dim_time.select(F.col("time_key").alias("start_time_key"), *by)
    per_minute = partials(star.completed(), ["start_time_key"], measures)
    return combine(per_minute.join(clock, "start_time_key"), by, measures)


def vw_outcomes_by_demographics(star: Star) -> DataFrame:
    age_group = bucket("patient_age", [30, 50, 65], ["< 30", "30-49", "50-64", "65+"], otherwise="Unknown")
    return summarise(
        star.completed().filter(F.col("patient_age").isNotNull()),
        ["patient_gender", age_group.alias("age_group")],
        [
            rows("procedure_count"),
            average("avg_complexity", "complexity_score"),
            rate("success_rate", successful()),
            average("avg_duration", "duration_minutes"),
            average("avg_blood_loss", "blood_loss_ml"),
            average("avg_hospital_stay", "hospital_stay_days"),
            average("avg_satisfaction", "patient_satisfaction_score"),
        ],
    )


def vw_telemetry_system_health(star: Star) -> DataFrame:
    """Samples are reduced per procedure_key before they meet the procedures on that same key."""
    measures = [
        rows("telemetry_sample_count"),
        average("avg_temperature", "system_temperature"),
        high("max_temperature", "system_temperature"),
        average("avg_motor_current", "motor_current"),
        high("max_motor_current", "motor_current"),
        average("avg_network_latency", "network_latency_ms"),
        high("max_network_latency", "network_latency_ms"),
        average("avg_video_fps", "video_fps"),
        low("min_video_fps", "video_fps"),
    ]
    per_procedure = partials(star.fact_procedure_telemetry, ["procedure_key"], measures)
    procedures = star.fact_procedures.select(
        "procedure_key", "procedure_id", "robot_key", "facility_key", "start_date_key"
    )
    robots = star.current("dim_robots").select("robot_key", "robot_model")
    facilities = star.current("dim_facilities").select("facility_key", "facility_name")
    joined = per_procedure.join(procedures, "procedure_key").join(robots, "robot_key").join(facilities, "facility_key")
    by = ["procedure_id", "robot_model", "facility_name", "date"]
    return combine(with_start_date(star, joined, "date"), by, measures)


def robot_utilization_all_versions(star: Star) -> DataFrame:
    """Utilisation by business key over every version of a robot, shown with its current attributes.

    The plain view keeps only facts that point at the current version.
    """
    measures = [
        rows("total_procedures"),
        hours("total_operating_hours", "duration_minutes"),
        average("avg_complexity", "complexity_score"),
    ]
    versions = star.dim_robots.select("robot_key", "robot_id")
    per_robot = combine(
        partials(star.fact_procedures, ["robot_key"], measures).join(versions, "robot_key"),
        ["robot_id"],
        [*measures, groups("version_count")],
    )
    now = star.current("dim_robots").select("robot_id", "robot_serial_number", "robot_model", "status")
    return per_robot.join(now, "robot_id")


WAREHOUSE_VIEWS = {
    f.__name__: f
    for f in (
        vw_robot_utilization,
        vw_robot_utilization_monthly,
        vw_procedure_outcomes,
        vw_outcomes_by_robot_model,
        vw_surgeon_performance,
        vw_surgeon_procedure_categories,
        vw_facility_performance,
        vw_daily_procedure_volume,
        vw_procedures_by_time_of_day,
        vw_outcomes_by_demographics,
        vw_telemetry_system_health,
    )
}

Tables = Mapping[str, DataFrame]


def op_robot_utilization(tables: Tables) -> DataFrame:
    """Every robot, those without procedures too, from the operational tables."""
    per_robot = tables["surgical_procedures"].groupBy("robot_id").agg(
        F.count("procedure_id").alias("procedure_count"),
        (F.sum("duration_minutes").cast("double") / F.nullif(F.count("duration_minutes"), F.lit(0))).alias(
            "avg_procedure_duration"
        ),
        F.max("start_time").alias("last_procedure_date"),
    )
    robots = tables["surgical_robots"].select(
        "robot_id", "robot_serial_number", "robot_model", "facility_name", "status"
    )
    return robots.join(per_robot, "robot_id", "left").withColumn(
        "procedure_count", F.coalesce("procedure_count", F.lit(0))
    )


def op_procedure_outcomes_summary(tables: Tables) -> DataFrame:
    """Detail rows of completed procedures with their outcome, if any."""
    robots = tables["surgical_robots"].select("robot_id", "robot_model", "facility_name")
    outcomes = tables["procedure_outcomes"].select(
        "procedure_id", "success_status", "blood_loss_ml", "hospital_stay_days", "patient_satisfaction_score"
    )
    return (
        tables["surgical_procedures"]
        .filter(F.col("status") == "completed")
        .select(
            "procedure_id",
            "robot_id",
            "procedure_type",
            "procedure_category",
            "start_time",
            "duration_minutes",
            "complexity_score",
        )
        .join(outcomes, "procedure_id", "left")
        .join(robots, "robot_id")
        .select(
            "procedure_id",
            "procedure_type",
            "procedure_category",
            "start_time",
            "duration_minutes",
            "complexity_score",
            "robot_model",
            "facility_name",
            "success_status",
            "blood_loss_ml",
            "hospital_stay_days",
            "patient_satisfaction_score",
        )
    )


def op_maintenance_costs(tables: Tables) -> DataFrame:
    """Every robot with its maintenance count, cost and downtime; no logs gives 0 and NULLs."""
    per_robot = tables["robot_maintenance_logs"].groupBy("robot_id").agg(
        F.count("maintenance_id").alias("maintenance_count"),
        F.sum("cost").alias("total_cost"),
        (F.sum("cost").cast("double") / F.nullif(F.count("cost"), F.lit(0))).alias("avg_cost"),
        F.sum("downtime_hours").alias("total_downtime_hours"),
    )
    robots = tables["surgical_robots"].select("robot_id", "robot_serial_number", "robot_model", "facility_name")
    return robots.join(per_robot, "robot_id", "left").withColumn(
        "maintenance_count", F.coalesce("maintenance_count", F.lit(0))
    )
