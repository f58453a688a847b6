"""Extracts from the operational tables and the staging of procedure facts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suturestar.functions.lists import items
from suturestar.functions.timekeys import date_key, full_years, moment, time_key
from suturestar.operators.lookup import Lookup, resolve_keys
from suturestar.operators.rows import greatest_per_key, only_new
from suturestar.plans.star import Star

SPECIALIZATION = "General Surgery"
CERTIFICATION = "Board Certified"

# What a change of makes a new version.
TRACKED = {
    "dim_surgeons": ("surgeon_name", "specialization"),
    "dim_robots": (
        "robot_serial_number",
        "robot_model",
        "manufacturer",
        "facility_key",
        "install_date",
        "software_version",
        "hardware_revision",
        "status",
        "last_maintenance_date",
    ),
    "dim_facilities": ("facility_name", "city", "state", "country", "facility_type", "bed_count"),
}


def window_of(start: date | None, end: date | None, today: date | None = None) -> tuple[date, date]:
    """The load window [start, end); by default yesterday."""
    today = today or date.today()
    return start or today - timedelta(days=1), end or today


def in_window(c: Column, start: date | datetime, end: date | datetime) -> Column:
    return (c >= moment(start)) & (c < moment(end))


def extract_surgeons(procedures: DataFrame, as_of: date) -> DataFrame:
    """One row per (id, name); `latest_start` tells which name of an id is the newest."""
    first = F.to_date(F.min("start_time"))
    return (
        procedures.filter(F.col("surgeon_id").isNotNull())
        .groupBy("surgeon_id", "surgeon_name")
        .agg(first.alias("effective_date"), F.max("start_time").alias("latest_start"))
        .select(
            "surgeon_id",
            "surgeon_name",
            F.lit(SPECIALIZATION).alias("specialization"),
            full_years(F.col("effective_date"), F.lit(as_of)).alias("years_experience"),
            F.lit(CERTIFICATION).alias("certification_level"),
            "effective_date",
            "latest_start",
        )
    )


def extract_robots(robots: DataFrame, procedures: DataFrame) -> DataFrame:
    """Robots with the count and hours of their procedures, 0 for none.

    The operational names installation_date and firmware_version become install_date and
    software_version; there is no hardware revision in the source.
    """
    work = procedures.groupBy("robot_id").agg(
        F.count("procedure_id").alias("n"), F.sum("duration_minutes").alias("minutes")
    )
    hours = (F.coalesce("minutes", F.lit(0)) / F.lit(60).cast("decimal(3,0)")).cast("decimal(10,2)")
    return robots.join(work, "robot_id", "left").select(
        "robot_id",
        "robot_serial_number",
        "robot_model",
        "manufacturer",
        "facility_id",
        F.col("installation_date").alias("install_date"),
        F.col("firmware_version").alias("software_version"),
        F.lit(None).cast("string").alias("hardware_revision"),
        "status",
        "last_maintenance_date",
        F.coalesce("n", F.lit(0)).cast("int").alias("total_procedures_count"),
        hours.alias("total_operating_hours"),
        F.col("installation_date").alias("effective_date"),
    )


def extract_facilities(robots: DataFrame, seed: DataFrame) -> DataFrame:
    """Facilities as the robots name them, with place, type and beds from the seed where it knows the id."""
    known = seed.select(
        "facility_id", F.col("facility_name").alias("seed_name"), "city", "state", "country", "facility_type", "bed_count"
    )
    named = robots.groupBy("facility_id").agg(
        F.max("facility_name").alias("facility_name"), F.min("installation_date").alias("effective_date")
    )
    return named.join(known, "facility_id", "left").select(
        "facility_id",
        F.coalesce("facility_name", "seed_name").alias("facility_name"),
        "city",
        "state",
        "country",
        "facility_type",
        "bed_count",
        "effective_date",
    )


def complication_level(status: Column, complications: Column) -> Column:
    """None, Minor, Moderate or Severe from the free text; NULL text stays NULL."""
    n = F.size(items(complications, ","))
    return (
        F.when(complications.isNull(), F.lit(None))
        .when(F.lower(F.trim(complications)) == "none", "None")
        .when(F.lower(status) == "failed", "Severe")
        .when(n == 1, "Minor")
        .when(n >= 2, "Moderate")
    )


def normalise_outcomes(outcomes: DataFrame) -> DataFrame:
    """Status words in the case the warehouse tests for, and the derived complication level."""
    return outcomes.withColumns(
        {
            "complication_level": complication_level(F.col("success_status"), F.col("complications")),
            "success_status": F.initcap("success_status"),
        }
    )


def extract_procedures(
    procedures: DataFrame,
    robots: DataFrame,
    outcomes: DataFrame,
    start: date | datetime,
    end: date | datetime,
) -> DataFrame:
    """Procedures that start in [start, end), with their robot's facility and their outcome, if any.

    Spark turns the window into a filter on the procedure scan; outcomes are joined to what is left.  They are joined
    last, so the rows lie by procedure for the steps that follow.
    """
    homes = robots.select("robot_id", "facility_id")
    results = normalise_outcomes(outcomes).select(
        "procedure_id",
        "success_status",
        "blood_loss_ml",
        "complication_level",
        "hospital_stay_days",
        "patient_satisfaction_score",
        "readmission_30day",
    )
    return (
        procedures.filter(in_window(F.col("start_time"), start, end))
        .join(homes, "robot_id", "left")
        .join(results, "procedure_id", "left")
        .select(
            "procedure_id",
            "robot_id",
            "surgeon_id",
            "facility_id",
            date_key(F.col("start_time")).alias("start_date_key"),
            time_key(F.col("start_time")).alias("start_time_key"),
            date_key(F.col("end_time")).alias("end_date_key"),
            time_key(F.col("end_time")).alias("end_time_key"),
            "procedure_type",
            "procedure_category",
            "patient_id",
            F.col("patient_age").cast("smallint").alias("patient_age"),
            "patient_gender",
            "duration_minutes",
            F.col("complexity_score").cast("decimal(3,1)").alias("complexity_score"),
            "success_status",
            "blood_loss_ml",
            "complication_level",
            "hospital_stay_days",
            F.col("patient_satisfaction_score").cast("decimal(3,1)").alias("patient_satisfaction_score"),
            "readmission_30day",
            "status",
        )
    )


def stage_facts(
    stage: DataFrame, star: Star, existing: DataFrame, cut: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> tuple[DataFrame, DataFrame]:
    """(new fact rows with dimension keys, the rejects among them).

    What the fact holds already is dropped first, so a repeated load sorts nothing, then copies within the batch; then
    keys are looked up.  `cut` may write the new rows down before that.
    """
    fresh = cut(greatest_per_key(only_new(stage, existing, ["procedure_id"]), ["procedure_id"]))
    return resolve_keys(
        fresh,
        {
            "robot": Lookup(star.dim_robots, "robot_id", "robot_key"),
            "surgeon": Lookup(star.dim_surgeons, "surgeon_id", "surgeon_key"),
            "facility": Lookup(star.dim_facilities, "facility_id", "facility_key"),
        },
    )
