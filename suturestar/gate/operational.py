"""The driver's tables as the operational tables, dimension snapshots and telemetry documents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.gate import tables as t

STAMP = "timestamp_ntz '2001-08-01 12:00:00'"
COMPLICATIONS = (
    "case when not any_open then 'none' when all_r then 'bleeding, infection, fever' "
    "when any_r and any_n then 'bleeding, infection' when any_r or any_n then 'bleeding' end"
)
OUTCOME = "case when not any_open then 'successful' when all_r then 'failed' else 'complicated' end"


def surgical_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = t.read(spark, sf_dir, "supplier"), t.read(spark, sf_dir, "nation")
    return supplier.join(nation, F.expr("s_nationkey = n_nationkey")).selectExpr(
        f"{t.robot_id('s_suppkey')} as robot_id",
        "s_name as robot_serial_number",
        "concat('Model-', cast(pmod(s_suppkey, 7) as string)) as robot_model",
        "concat('Maker-', cast(pmod(s_suppkey, 3) as string)) as manufacturer",
        "date_add(date '1994-01-01', cast(pmod(s_suppkey, 365) as int)) as installation_date",
        f"{t.facility_id('s_nationkey')} as facility_id",
        "n_name as facility_name",
        "case when s_acctbal >= 1000 then 'operational' when s_acctbal >= 0 then 'maintenance' "
        "when s_acctbal >= -500 then 'retired' else 'lost' end as status",
        "case when s_acctbal >= 5000 then date '2000-06-30' end as last_maintenance_date",
        "0 as total_procedures",
        "case when pmod(s_suppkey, 5) <> 0 then concat('v', cast(pmod(s_suppkey, 5) as string)) end as firmware_version",
        f"{STAMP} as created_at",
        f"{STAMP} as updated_at",
    )


def surgical_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without lines keep NULLs, as records that break the model's rules."""
    parts = t.read(spark, sf_dir, "part").groupBy("p_partkey").agg(F.expr("min(p_size) as size"))
    return (
        t.orders(spark, sf_dir)
        .join(t.order_lines(spark, sf_dir), F.expr("o_orderkey = l_orderkey"), "left")
        .join(parts, F.expr("part = p_partkey"), "left")
        .selectExpr(
            f"{t.procedure_id('o_orderkey')} as procedure_id",
            f"coalesce({t.robot_id('robot')}, 'RBT-NONE') as robot_id",
            f"{t.PROCEDURE_TYPE} as procedure_type",
            "o_orderpriority as procedure_category",
            f"{t.START_TIME} as start_time",
            f"{t.END_TIME} as end_time",
            "cast(minutes as int) as duration_minutes",
            "case when pmod(o_custkey, 50) <> 0 then concat('SURG-', cast(o_custkey as string)) end as surgeon_id",
            "concat('Dr. ', cast(pmod(o_custkey, 100) as string)) as surgeon_name",
            "concat('PAT-', cast(o_custkey as string)) as patient_id",
            "size * 3 as patient_age",
            f"{t.GENDER} as patient_gender",
            f"cast({t.COMPLEXITY_TENTHS} / 10 as decimal(3,2)) as complexity_score",
            f"{t.STATUS} as status",
            f"{STAMP} as created_at",
        )
    )


def procedure_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.order_lines(spark, sf_dir).selectExpr(
        "concat('OUT-', cast(l_orderkey as string)) as outcome_id",
        f"{t.procedure_id('l_orderkey')} as procedure_id",
        f"{OUTCOME} as success_status",
        "cast(tax * 10 as int) as blood_loss_ml",
        f"{COMPLICATIONS} as complications",
        "cast(lines as int) as hospital_stay_days",
        "high_tax >= 8 as readmission_30day",
        "cast(high_line + 2 as int) as patient_satisfaction_score",
        "cast(null as string) as surgeon_notes",
        "cast(pmod(minutes, 120) as int) as recovery_score",
        "any_r as follow_up_required",
        f"{STAMP} as created_at",
        f"{STAMP} as updated_at",
    )


def robot_maintenance_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of every second robot; some name a robot that does not exist."""
    return (
        t.read(spark, sf_dir, "events")
        .withColumn("k", F.expr(t.METRIC))
        .selectExpr(
            "concat('MNT-', cast(event_id as string)) as maintenance_id",
            f"{t.robot_id('user_id * 2')} as robot_id",
            "to_date(ts) as maintenance_date",
            "case event_type when 'error' then 'emergency' when 'view' then 'routine' when 'click' then 'calibration' "
            "when 'purchase' then 'upgrade' else event_type end as maintenance_type",
            "concat('TECH-', cast(pmod(event_id, 9) as string)) as technician_id",
            "concat('Technician ', cast(pmod(event_id, 9) as string)) as technician_name",
            "cast(null as string) as issues_found",
            "case when k >= 50 then 'inspected; cleaned' else 'inspected' end as actions_taken",
            "cast(null as string) as parts_replaced",
            "cast(k / 10 as decimal(6,2)) as downtime_hours",
            "date_add(to_date(ts), 90) as next_maintenance_date",
            "case when k <> 7 then cast(value as decimal(10,2)) end as cost",
            f"{STAMP} as created_at",
        )
    )


class OperationalTables(dict):
    """Tables built when they are asked for."""

    BUILDERS = {
        "surgical_robots": surgical_robots,
        "robot_maintenance_logs": robot_maintenance_logs,
        "surgical_procedures": surgical_procedures,
        "procedure_outcomes": procedure_outcomes,
    }

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.BUILDERS[name](self.spark, self.sf_dir)
        return self[name]

    def all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in self.BUILDERS}


# Two states of the fleet, for the versioned dimension.
FIRST_RUN, SECOND_RUN = date(1998, 1, 1), date(2000, 1, 1)


def first_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the robots that are bought later."""
    return _fleet(spark, sf_dir).filter("s_acctbal < 9000").drop("s_acctbal")


def second_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some robots gone, some with a new status, some that lost their software version."""
    return (
        _fleet(spark, sf_dir)
        .filter("s_acctbal >= -500")
        .withColumns(
            {
                "status": F.expr("if(s_acctbal between 2000 and 4000, 'upgraded', status)"),
                "software_version": F.expr("if(s_acctbal between 3500 and 5000, null, software_version)"),
                "total_procedures_count": F.lit(99),
            }
        )
        .drop("s_acctbal")
    )


def _fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.read(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal",
        f"{t.robot_id('s_suppkey')} as robot_id",
        "s_name as robot_serial_number",
        "concat('Model-', cast(pmod(s_suppkey, 7) as string)) as robot_model",
        "concat('Maker-', cast(pmod(s_suppkey, 3) as string)) as manufacturer",
        "cast(s_nationkey as int) as facility_key",
        "date '1994-01-01' as install_date",
        "case when pmod(s_suppkey, 5) <> 0 then concat('v', cast(pmod(s_suppkey, 5) as string)) end as software_version",
        "cast(null as string) as hardware_revision",
        "case when s_acctbal >= 1000 then 'operational' else 'maintenance' end as status",
        "cast(null as date) as last_maintenance_date",
        "0 as total_procedures_count",
        "cast(0 as decimal(10,2)) as total_operating_hours",
        "date '1994-01-01' as effective_date",
    )


def telemetry_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event: nested for even ids, flat for odd ones, every 50th without a usable time."""
    even = "pmod(event_id, 2) = 0"
    offset = "case pmod(event_id, 3) when 0 then 'Z' when 1 then '+05:00' else '' end"
    stamp = f"concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), {offset})"
    fps = "cast(70 - floor(k / 2) as int)"
    return (
        t.read(spark, sf_dir, "events")
        .withColumn("k", F.expr(t.METRIC))
        .selectExpr(
            "event_id",
            f"{t.procedure_id('user_id')} as procedure_id",
            f"if(k = 13, null, {t.robot_id('user_id')}) as robot_id",
            f"case when pmod(event_id, 50) = 49 then 'soon' else {stamp} end as timestamp",
            "event_type as tool_type",
            "k >= 50 as tool_active",
            f"if({even}, named_struct('x', value, 'y', 1.5D), null) as arm_position",
            f"if({even}, null, value) as arm_position_x",
            f"if({even}, named_struct('temperature', value, 'network_latency_ms', k + 10, 'video_fps', {fps}), null)"
            " as system_metrics",
            f"if({even}, null, value) as system_temperature",
            f"if({even}, null, k + 10) as network_latency_ms",
            f"if({even}, null, {fps}) as video_fps",
        )
    )


def write_documents(spark: SparkSession, sf_dir: str, path: str, **options) -> None:
    """NDJSON files below the `telemetry/` prefix; NULL fields are left out."""
    telemetry_documents(spark, sf_dir).drop("event_id").write.options(**options).json(f"{path}/telemetry")
