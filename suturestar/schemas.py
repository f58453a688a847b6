"""Table layouts: operational tables, telemetry documents and the star."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from suturestar.functions.timekeys import moment

# The column names, order and types of the public data model.
OPERATIONAL_DDL = {
    "surgical_robots": """
        robot_id STRING NOT NULL, robot_serial_number STRING NOT NULL, robot_model STRING NOT NULL,
        manufacturer STRING NOT NULL, installation_date DATE NOT NULL, facility_id STRING NOT NULL,
        facility_name STRING NOT NULL, status STRING NOT NULL, last_maintenance_date DATE,
        total_procedures INT, firmware_version STRING, created_at TIMESTAMP_NTZ NOT NULL,
        updated_at TIMESTAMP_NTZ NOT NULL""",
    "robot_maintenance_logs": """
        maintenance_id STRING NOT NULL, robot_id STRING NOT NULL, maintenance_date DATE NOT NULL,
        maintenance_type STRING NOT NULL, technician_id STRING NOT NULL, technician_name STRING NOT NULL,
        issues_found STRING, actions_taken STRING, parts_replaced STRING, downtime_hours DECIMAL(6,2),
        next_maintenance_date DATE, cost DECIMAL(10,2), created_at TIMESTAMP_NTZ NOT NULL""",
    "surgical_procedures": """
        procedure_id STRING NOT NULL, robot_id STRING NOT NULL, procedure_type STRING NOT NULL,
        procedure_category STRING NOT NULL, start_time TIMESTAMP_NTZ NOT NULL,
        end_time TIMESTAMP_NTZ NOT NULL, duration_minutes INT NOT NULL, surgeon_id STRING NOT NULL,
        surgeon_name STRING NOT NULL, patient_id STRING NOT NULL, patient_age INT NOT NULL,
        patient_gender STRING, complexity_score DECIMAL(3,2), status STRING NOT NULL,
        created_at TIMESTAMP_NTZ NOT NULL""",
    "procedure_outcomes": """
        outcome_id STRING NOT NULL, procedure_id STRING NOT NULL, success_status STRING NOT NULL,
        blood_loss_ml INT, complications STRING, hospital_stay_days INT, readmission_30day BOOLEAN,
        patient_satisfaction_score INT, surgeon_notes STRING, recovery_score INT,
        follow_up_required BOOLEAN, created_at TIMESTAMP_NTZ NOT NULL, updated_at TIMESTAMP_NTZ NOT NULL""",
}

STAR_DDL = {
    "dim_date": """
        date_key INT NOT NULL, date DATE NOT NULL, year SMALLINT NOT NULL, quarter SMALLINT NOT NULL,
        month SMALLINT NOT NULL, month_name STRING NOT NULL, week SMALLINT NOT NULL,
        day_of_month SMALLINT NOT NULL, day_of_week SMALLINT NOT NULL, day_name STRING NOT NULL,
        is_weekend BOOLEAN NOT NULL, is_holiday BOOLEAN, fiscal_year SMALLINT NOT NULL,
        fiscal_quarter SMALLINT NOT NULL""",
    "dim_time": """
        time_key INT NOT NULL, time_value STRING NOT NULL, hour SMALLINT NOT NULL,
        minute SMALLINT NOT NULL, second SMALLINT NOT NULL, hour_12 SMALLINT NOT NULL,
        am_pm STRING NOT NULL, time_of_day STRING NOT NULL, business_hours BOOLEAN NOT NULL""",
    "dim_facilities": """
        facility_key INT NOT NULL, facility_id STRING NOT NULL, facility_name STRING NOT NULL,
        city STRING, state STRING, country STRING, facility_type STRING, bed_count INT,
        effective_date DATE NOT NULL, expiration_date DATE, is_current BOOLEAN NOT NULL""",
    "dim_surgeons": """
        surgeon_key INT NOT NULL, surgeon_id STRING NOT NULL, surgeon_name STRING NOT NULL,
        specialization STRING, years_experience INT, certification_level STRING,
        effective_date DATE NOT NULL, expiration_date DATE, is_current BOOLEAN NOT NULL""",
    "dim_robots": """
        robot_key INT NOT NULL, robot_id STRING NOT NULL, robot_serial_number STRING NOT NULL,
        robot_model STRING NOT NULL, manufacturer STRING, facility_key INT, install_date DATE,
        software_version STRING, hardware_revision STRING, status STRING, last_maintenance_date DATE,
        total_procedures_count INT, total_operating_hours DECIMAL(10,2), effective_date DATE NOT NULL,
        expiration_date DATE, is_current BOOLEAN NOT NULL""",
    "fact_procedures": """
        procedure_key BIGINT NOT NULL, procedure_id STRING NOT NULL, robot_key INT NOT NULL,
        surgeon_key INT NOT NULL, facility_key INT NOT NULL, start_date_key INT NOT NULL,
        start_time_key INT NOT NULL, end_date_key INT, end_time_key INT, procedure_type STRING NOT NULL,
        procedure_category STRING NOT NULL, patient_id STRING, patient_age SMALLINT,
        patient_gender STRING, duration_minutes INT, complexity_score DECIMAL(3,1),
        success_status STRING, blood_loss_ml INT, complication_level STRING, hospital_stay_days INT,
        patient_satisfaction_score DECIMAL(3,1), readmission_30day BOOLEAN, status STRING NOT NULL,
        created_at TIMESTAMP_NTZ NOT NULL, updated_at TIMESTAMP_NTZ""",
    "fact_procedure_telemetry": """
        telemetry_key BIGINT NOT NULL, procedure_key BIGINT NOT NULL, timestamp_key INT NOT NULL,
        sample_timestamp TIMESTAMP_NTZ NOT NULL, arm_position_x DECIMAL(10,4),
        arm_position_y DECIMAL(10,4), arm_position_z DECIMAL(10,4), arm_rotation_x DECIMAL(10,4),
        arm_rotation_y DECIMAL(10,4), arm_rotation_z DECIMAL(10,4), force_feedback DECIMAL(10,4),
        tool_type STRING, tool_active BOOLEAN, camera_zoom DECIMAL(5,2), lighting_level INT,
        system_temperature DECIMAL(5,2), motor_current DECIMAL(8,4), network_latency_ms INT,
        video_fps INT, created_at TIMESTAMP_NTZ NOT NULL""",
}

# Raw telemetry.  Every leaf is read as text and typed later, so one odd value does not cost the record.
TELEMETRY_DOCUMENT_DDL = """
    telemetry_id STRING, procedure_id STRING, robot_id STRING, timestamp STRING,
    arm_position STRUCT<x: STRING, y: STRING, z: STRING>,
    arm_rotation STRING, arm_position_x STRING, arm_position_y STRING, arm_position_z STRING,
    force_feedback STRING, force_feedback_x STRING, force_feedback_y STRING, force_feedback_z STRING,
    tool_type STRING, tool_active STRING, grip_pressure STRING, tremor_compensation STRING,
    camera_zoom STRING, camera_angle STRING, lighting_level STRING,
    system_metrics STRUCT<temperature: STRING, motor_current: STRING, network_latency_ms: STRING,
                          video_fps: STRING>,
    system_temperature STRING, power_consumption STRING, motor_current STRING,
    network_latency_ms STRING, video_fps STRING, _corrupt STRING"""

# The 18 staged telemetry columns in order, with their types.
TELEMETRY_STAGE = {
    "procedure_id": "string",
    "timestamp_key": "int",
    "sample_timestamp": "timestamp_ntz",
    "arm_position_x": "decimal(10,4)",
    "arm_position_y": "decimal(10,4)",
    "arm_position_z": "decimal(10,4)",
    "arm_rotation_x": "decimal(10,4)",
    "arm_rotation_y": "decimal(10,4)",
    "arm_rotation_z": "decimal(10,4)",
    "force_feedback": "decimal(10,4)",
    "tool_type": "string",
    "tool_active": "boolean",
    "camera_zoom": "decimal(5,2)",
    "lighting_level": "int",
    "system_temperature": "decimal(5,2)",
    "motor_current": "decimal(8,4)",
    "network_latency_ms": "int",
    "video_fps": "int",
}
TELEMETRY_STAGE_DDL = ", ".join(f"{name} {kind}" for name, kind in TELEMETRY_STAGE.items())

UNKNOWN_KEY = -1

# Values for columns that a record may leave out; `NOW` is replaced by the load time.
NOW = object()
DEFAULTS = {
    "surgical_robots": {"total_procedures": 0, "created_at": NOW, "updated_at": NOW},
    "robot_maintenance_logs": {"created_at": NOW},
    "surgical_procedures": {"created_at": NOW},
    "procedure_outcomes": {
        "readmission_30day": False,
        "follow_up_required": False,
        "created_at": NOW,
        "updated_at": NOW,
    },
    "dim_date": {"is_holiday": False},
    "dim_robots": {"total_procedures_count": 0, "total_operating_hours": 0, "is_current": True},
    "dim_facilities": {"is_current": True},
    "dim_surgeons": {"is_current": True},
    "fact_procedures": {"status": "completed", "created_at": NOW},
    "fact_procedure_telemetry": {"created_at": NOW},
}


def schema_of(table: str) -> StructType:
    ddl = OPERATIONAL_DDL.get(table) or STAR_DDL.get(table)
    if ddl is None:
        raise KeyError(table)
    return StructType.fromDDL(ddl)


def nullable(schema: StructType) -> StructType:
    """The same fields, all nullable: what a text source can promise."""
    out = StructType()
    for field in schema.fields:
        out.add(field.name, field.dataType, True)
    return out


def _default(value: object, now: datetime | None) -> Column:
    if value is NOW:
        return F.current_timestamp().cast("timestamp_ntz") if now is None else moment(now)
    return F.lit(value)


def conform(df: DataFrame, table: str, now: datetime | None = None) -> DataFrame:
    """Select the table's columns in order, typed, with the table's defaults filled in.

    Columns missing from `df` become NULL or their default; extra ones are dropped.
    """
    have = set(df.columns)
    defaults = DEFAULTS.get(table, {})
    out = []
    for field in schema_of(table).fields:
        c = F.col(field.name) if field.name in have else F.lit(None)
        c = c.cast(field.dataType)
        if field.name in defaults:
            c = F.coalesce(c, _default(defaults[field.name], now).cast(field.dataType))
        out.append(c.alias(field.name))
    return df.select(*out)


def fill_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def as_day(value: date | datetime | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value)
