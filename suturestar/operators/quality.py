"""Constraint checks that report violations instead of failing."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from suturestar.schemas import OPERATIONAL_DDL

# The CHECK constraints of the operational tables, as SQL conditions.
CHECKS: dict[str, dict[str, str]] = {
    "surgical_robots": {
        "status": "status in ('operational', 'maintenance', 'retired')",
    },
    "robot_maintenance_logs": {
        "maintenance_type": "maintenance_type in ('routine', 'emergency', 'upgrade', 'calibration')",
    },
    "surgical_procedures": {
        "patient_age": "patient_age between 0 and 120",
        "complexity_score": "complexity_score between 1.0 and 5.0",
        "status": "status in ('completed', 'in_progress', 'aborted', 'cancelled')",
        "end_after_start": "end_time >= start_time",
    },
    "procedure_outcomes": {
        "success_status": "success_status in ('successful', 'complicated', 'failed')",
        "blood_loss_ml": "blood_loss_ml >= 0",
        "hospital_stay_days": "hospital_stay_days >= 0",
        "patient_satisfaction_score": "patient_satisfaction_score between 1 and 10",
        "recovery_score": "recovery_score between 1 and 100",
    },
}

UNIQUE = {
    "surgical_robots": (("robot_id",), ("robot_serial_number",)),
    "robot_maintenance_logs": (("maintenance_id",),),
    "surgical_procedures": (("procedure_id",),),
    "procedure_outcomes": (("outcome_id",), ("procedure_id",)),
}

# The VARCHAR limits of the operational tables.
LENGTHS: dict[str, dict[str, int]] = {
    "surgical_robots": {
        "robot_serial_number": 50,
        "robot_model": 100,
        "manufacturer": 100,
        "facility_id": 50,
        "facility_name": 200,
        "status": 20,
        "firmware_version": 20,
    },
    "robot_maintenance_logs": {"maintenance_type": 50, "technician_id": 50, "technician_name": 200},
    "surgical_procedures": {
        "procedure_type": 100,
        "procedure_category": 50,
        "surgeon_id": 50,
        "surgeon_name": 200,
        "patient_id": 50,
        "patient_gender": 20,
        "status": 20,
    },
    "procedure_outcomes": {"success_status": 20},
}

# Fields an ingested telemetry record must carry.
TELEMETRY_REQUIRED = ("procedure_id", "timestamp", "robot_id")


def not_null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNotNull() for c in columns}


def length_rules(limits: Mapping[str, int]) -> dict[str, Column]:
    """VARCHAR(n) limits."""
    return {f"{c} longer than {n}": F.length(c) <= n for c, n in limits.items()}


def check_rules(table: str) -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in CHECKS[table].items()}


def required_columns(table: str) -> list[str]:
    """The table's NOT NULL columns, read from its definition so that no session is needed."""
    return re.findall(r"(\w+) \w+(?:\([\d,]+\))? NOT NULL", OPERATIONAL_DDL[table])


def model_rules(table: str) -> dict[str, Column]:
    """Every NOT NULL, VARCHAR and CHECK rule of an operational table."""
    return {**not_null_rules(required_columns(table)), **length_rules(LENGTHS[table]), **check_rules(table)}


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) for every rule, unbroken ones too: one scan, one row a task into the exchange."""
    counts = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(True))).alias(f"rule{i}") for i, rule in enumerate(rules.values())])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"rule{i}").alias("violations")) for i, name in enumerate(rules)]
    return counts.select(F.inline(F.array(*pairs)))


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks; like a SQL CHECK, a rule that is NULL passes."""
    names = [F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def validate(df: DataFrame, rules: Mapping[str, Column], id_cols: Sequence[str]) -> DataFrame:
    """One row per (record, broken rule); all rules in one scan, without a shuffle."""
    return df.select(*id_cols, F.explode(broken_rules(rules)).alias("rule"))


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL never collides."""
    present = df.select(*keys).dropna()
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def foreign_key_violations(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key the parent lacks."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(parents, key, "left_anti")


def split_required(df: DataFrame, required: Sequence[str] = TELEMETRY_REQUIRED) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with a `reason` naming the first missing field).

    An absent field is refused; one that is present but null cannot be told apart here and is too.
    """
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"Missing required field: {c}")) for c in required])
    tagged = df.withColumn("reason", missing)
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table; versioned dimensions count current rows."""
    parts = []
    for name, df in tables.items():
        if name.startswith("dim_") and "is_current" in df.columns:
            df = df.filter("is_current")
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fact_sanity(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_procedures"),
        F.count_distinct("robot_key").alias("unique_robots"),
        F.min("start_date_key").alias("earliest_date"),
        F.max("start_date_key").alias("latest_date"),
    )


def version_overlaps(dim: DataFrame, key: str) -> DataFrame:
    """Business keys with two current versions, or with a version that starts before an earlier one ends."""
    end = F.coalesce("expiration_date", F.lit("9999-12-31").cast("date"))
    earlier = Window.partitionBy(key).orderBy("effective_date", end).rowsBetween(Window.unboundedPreceding, -1)
    tagged = dim.select(
        key, "effective_date", F.max(end).over(earlier).alias("busy_until"), F.col("is_current").cast("int").alias("now")
    )
    overlapping = F.max((F.col("effective_date") <= F.col("busy_until")).cast("int"))
    return (
        tagged.groupBy(key)
        .agg(F.coalesce(overlapping, F.lit(0)).alias("overlapping"), F.sum("now").alias("current_versions"))
        .filter("overlapping = 1 or current_versions > 1")
    )
