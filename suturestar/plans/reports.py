"""The fifteen business reports on the star.

Relative windows take `as_of` (the reports' CURRENT_DATE).  The window is applied to the calendar and,
as an equivalent integer bound, to the fact's own date key, so date-partitioned facts prune
statically.  Every limit sorts by a unique last key, which settles ties the reference leaves open.
"""

from __future__ import annotations

from datetime import date, timedelta

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from suturestar.functions.measures import (
    average,
    average_if,
    bucket,
    combine,
    distinct,
    groups,
    high,
    hits,
    hours,
    partials,
    rate,
    rows,
    summarise,
)
from suturestar.plans.star import Star
from suturestar.plans.views import (
    by_clock,
    by_robot,
    by_surgeon,
    no_complication,
    readmitted,
    robots_at_facilities,
    serious,
    successful,
    with_start_date,
)


def _since(star: Star, first: date) -> DataFrame:
    return star.completed_since(first)


def _success_pct():
    return rate("success_rate_pct", successful(), 2)


def q01_platform_metrics(star: Star, as_of: date, days: int = 30) -> DataFrame:
    measures = [
        rows("total_procedures"),
        distinct("active_robots", "robot_key"),
        distinct("active_surgeons", "surgeon_key"),
        distinct("active_facilities", "facility_key"),
        average("avg_procedure_duration_min", "duration_minutes", 2),
        hours("total_operating_hours", "duration_minutes", 2),
        average("avg_patient_satisfaction", "patient_satisfaction_score", 2),
        _success_pct(),
    ]
    recent = with_start_date(star, _since(star, as_of - timedelta(days=days)))
    keys = ["robot_key", "surgeon_key", "facility_key"]
    joined = partials(recent, keys, measures)
    for dim, key in zip(("dim_robots", "dim_surgeons", "dim_facilities"), keys):
        joined = joined.join(star.current(dim).select(key), key)
    return combine(joined, [], measures)


def q02_top_robots(star: Star, n: int = 10) -> DataFrame:
    by = ["robot_id", "robot_serial_number", "robot_model", "facility_name"]
    measures = [
        rows("procedure_count"),
        hours("operating_hours", "duration_minutes", 2),
        average("avg_complexity", "complexity_score", 2),
        _success_pct(),
    ]
    per_robot = partials(star.completed(), ["robot_key"], measures)
    joined = per_robot.join(robots_at_facilities(star, "facility_name"), "robot_key")
    return combine(joined, by, measures).orderBy(F.desc("procedure_count"), *by).limit(n)


def q03_monthly_trend(star: Star, as_of: date, months: int = 12) -> DataFrame:
    measures = [
        rows("procedure_count"),
        average("avg_duration", "duration_minutes", 2),
        hours("total_hours", "duration_minutes", 2),
        _success_pct(),
    ]
    per_day = partials(_since(star, as_of - relativedelta(months=months)), ["start_date_key"], measures)
    dated = with_start_date(star, per_day, "date", "year", "month_name")
    by = [F.date_format("date", "yyyy-MM").alias("year_month"), F.col("year"), F.col("month_name")]
    return combine(dated, by, measures).orderBy("year_month")


def q04_complications_by_type(star: Star) -> DataFrame:
    level = F.col("complication_level")
    return summarise(
        star.completed(),
        ["procedure_type", "procedure_category"],
        [
            rows("total_procedures"),
            hits("no_complications", level == "None"),
            hits("minor_complications", level == "Minor"),
            hits("moderate_complications", level == "Moderate"),
            hits("severe_complications", level == "Severe"),
            rate("serious_complication_rate_pct", serious(), 2),
        ],
    ).orderBy(F.desc("total_procedures"), "procedure_type", "procedure_category")


def q05_outcomes_by_model(star: Star, at_least: int = 10) -> DataFrame:
    measures = [
        rows("procedure_count"),
        average("avg_duration_min", "duration_minutes", 2),
        average("avg_blood_loss_ml", "blood_loss_ml", 2),
        average("avg_hospital_stay_days", "hospital_stay_days", 2),
        average("avg_satisfaction", "patient_satisfaction_score", 2),
        rate("readmission_rate_pct", readmitted(), 2),
        _success_pct(),
    ]
    return (
        by_robot(star, star.completed(), ["robot_model", "manufacturer"], measures)
        .filter(F.col("procedure_count") >= at_least)
        .orderBy(F.desc("procedure_count"), "robot_model", "manufacturer")
    )


def q06_readmission_by_category(star: Star) -> DataFrame:
    again = readmitted()
    return summarise(
        star.completed(),
        ["procedure_category"],
        [
            rows("total_procedures"),
            hits("readmission_count", again),
            rate("readmission_rate_pct", again, 2),
            average_if("avg_stay_with_readmission", again, "hospital_stay_days", 2),
            average_if("avg_stay_no_readmission", ~again, "hospital_stay_days", 2),
        ],
    ).orderBy(F.desc("readmission_rate_pct"), "procedure_category")


def q07_top_surgeons(star: Star, at_least: int = 20, n: int = 20) -> DataFrame:
    by = ["surgeon_name", "specialization", "years_experience"]
    measures = [
        rows("procedure_count"),
        average("avg_complexity", "complexity_score", 2),
        average("avg_duration_min", "duration_minutes", 2),
        _success_pct(),
        average("avg_satisfaction", "patient_satisfaction_score", 2),
        rate("no_complication_rate_pct", no_complication(), 2),
    ]
    return (
        by_surgeon(star, by, measures)
        .filter(F.col("procedure_count") >= at_least)
        .orderBy(F.desc("success_rate_pct"), F.desc("avg_satisfaction"), *by)
        .limit(n)
    )


def experience_band(c: str = "years_experience") -> Column:
    return bucket(c, [5, 10, 15], ["0-4 years", "5-9 years", "10-14 years", "15+ years"])


def q08_experience_bands(star: Star) -> DataFrame:
    """Bands sort as text, and surgeons without a known experience form a NULL band."""
    measures = [
        groups("surgeon_count"),
        rows("procedure_count"),
        average("avg_duration", "duration_minutes", 2),
        _success_pct(),
        average("avg_satisfaction", "patient_satisfaction_score", 2),
        average("avg_complexity", "complexity_score", 2),
    ]
    per_surgeon = partials(star.completed(), ["surgeon_key"], measures)
    surgeons = star.current("dim_surgeons").select("surgeon_key", experience_band().alias("experience_group"))
    return combine(per_surgeon.join(surgeons, "surgeon_key"), ["experience_group"], measures).orderBy(
        "experience_group"
    )


def q09_facility_comparison(star: Star) -> DataFrame:
    by = ["facility_name", "city", "state", "facility_type"]
    measures = [
        groups("robot_count"),
        rows("procedure_count"),
        average("avg_duration", "duration_minutes", 2),
        _success_pct(),
        average("avg_hospital_stay", "hospital_stay_days", 2),
        average("avg_satisfaction", "patient_satisfaction_score", 2),
    ]
    per_robot = partials(star.completed(), ["robot_key"], measures)
    joined = per_robot.join(robots_at_facilities(star, *by), "robot_key")
    return combine(joined, by, measures).orderBy(F.desc("procedure_count"), *by)


def q10_facility_efficiency(star: Star, as_of: date, days: int = 90, hours_per_day: int = 8) -> DataFrame:
    """Hours worked against robots x operating days x hours a day."""
    measures = [
        distinct("robot_count", "robot_key"),
        distinct("operating_days", "date"),
        rows("procedure_count"),
        hours("hours__", "duration_minutes"),
    ]
    recent = with_start_date(star, _since(star, as_of - timedelta(days=days)), "date")
    per_robot_day = partials(recent, ["robot_key", "date"], measures)
    joined = per_robot_day.join(robots_at_facilities(star, "facility_name"), "robot_key")
    capacity = F.col("robot_count") * F.col("operating_days") * hours_per_day
    return (
        combine(joined, ["facility_name"], measures)
        .select(
            "facility_name",
            "robot_count",
            "operating_days",
            "procedure_count",
            F.round("hours__", 2).alias("actual_operating_hours"),
            capacity.alias("potential_capacity_hours"),
            F.round(F.col("hours__") / F.nullif(capacity, F.lit(0)) * 100, 2).alias("utilization_rate_pct"),
        )
        .orderBy(F.desc("utilization_rate_pct"), "facility_name")
    )


def q11_robot_health(
    star: Star, max_temperature: float = 75, max_latency_ms: int = 100, min_fps: int = 25, at_least: int = 5
) -> DataFrame:
    """Warnings are counted per sample.  Telemetry is reduced per procedure, then per robot."""
    warning = (
        (F.col("system_temperature") > max_temperature)
        | (F.col("network_latency_ms") > max_latency_ms)
        | (F.col("video_fps") < min_fps)
    )
    measures = [
        groups("procedure_count"),
        average("avg_temperature", "system_temperature", 2),
        high("max_temperature", "system_temperature", 2),
        average("avg_motor_current", "motor_current", 4),
        average("avg_network_latency", "network_latency_ms", 2),
        average("avg_video_fps", "video_fps", 2),
        hits("warning_count", warning),
    ]
    per_procedure = partials(star.fact_procedure_telemetry, ["procedure_key"], measures)
    robots = star.current("dim_robots").select("robot_key", "robot_id", "robot_model")
    joined = per_procedure.join(
        star.fact_procedures.select("procedure_key", "robot_key"), "procedure_key"
    ).join(robots, "robot_key")
    by = ["robot_id", "robot_model"]
    return (
        combine(joined, by, measures)
        .filter(F.col("procedure_count") >= at_least)
        .orderBy(F.desc("warning_count"), F.desc("procedure_count"), *by)
    )


def q12_day_of_week(star: Star, as_of: date, days: int = 90) -> DataFrame:
    by = ["day_name", "day_of_week"]
    measures = [rows("procedure_count"), average("avg_duration", "duration_minutes", 2), _success_pct()]
    per_day = partials(_since(star, as_of - timedelta(days=days)), ["start_date_key"], measures)
    return combine(with_start_date(star, per_day, *by), by, measures).orderBy("day_of_week")


def q13_time_of_day(star: Star) -> DataFrame:
    part = F.col("time_of_day")
    order = (
        F.when(part == "Morning", 1).when(part == "Afternoon", 2).when(part == "Evening", 3).when(part == "Night", 4)
    )
    return by_clock(
        star,
        ["time_of_day"],
        [
            rows("procedure_count"),
            average("avg_duration", "duration_minutes", 2),
            average("avg_complexity", "complexity_score", 2),
            _success_pct(),
            average("avg_satisfaction", "patient_satisfaction_score", 2),
        ],
    ).orderBy(order)


def q14_period_growth(star: Star) -> DataFrame:
    """Growth over the preceding row, which is the preceding quarter that has procedures.

    The window has no partition, but runs over one row per quarter.
    """
    by = ["year", "quarter"]
    measures = [rows("procedure_count"), hours("operating_hours", "duration_minutes", 2)]
    per_day = partials(star.completed(), ["start_date_key"], measures)
    quarters = combine(with_start_date(star, per_day, *by), by, measures)
    previous = F.lag("procedure_count").over(Window.orderBy(*by))
    growth = (F.col("procedure_count").cast("double") - F.col("prev_period_count")) / F.nullif(
        F.col("prev_period_count"), F.lit(0)
    )
    return (
        quarters.withColumn("prev_period_count", previous)
        .withColumn("growth_rate_pct", F.round(growth * 100, 2))
        .orderBy(*by)
    )


def q15_age_cohorts(star: Star) -> DataFrame:
    age_group = bucket("patient_age", [30, 50, 65], ["Under 30", "30-49", "50-64", "65+"])
    return summarise(
        star.completed().filter(F.col("patient_age").isNotNull()),
        [age_group.alias("age_group"), "procedure_category"],
        [
            rows("procedure_count"),
            average("avg_complexity", "complexity_score", 2),
            average("avg_duration", "duration_minutes", 2),
            average("avg_blood_loss", "blood_loss_ml", 2),
            average("avg_hospital_stay", "hospital_stay_days", 2),
            _success_pct(),
        ],
    ).orderBy("age_group", "procedure_category")
