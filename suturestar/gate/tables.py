"""The driver's TPC-H-like tables read as a robot fleet.

orders are procedures, lineitem per order is the outcome, supplier is the robot, nation the facility,
customer the surgeon, part gives type and age, events are telemetry and maintenance.  Surrogate keys
are the tables' own keys; -1 is the unknown member.

The side tables of the fact are grouped to one row per join key.  For lineitem that is the work to
do; for supplier and part (already unique) it lets Catalyst see the uniqueness and drop the join from
every query that does not use its columns.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from suturestar.plans import dims
from suturestar.plans.star import Star
from suturestar.schemas import UNKNOWN_KEY

AS_OF = date(2001, 8, 1)
LOAD_TIME = datetime(2001, 8, 1, 12, 0, 0)
SPINE_START = date(1995, 1, 1)
SPINE_DAYS = 3653

# The mapping, as SQL expressions over the driver's columns.

# Orders are dated at midnight; the price gives the minute of the day.
START_TIME = "o_orderdate + make_dt_interval(0, 0, cast(pmod(floor(o_totalprice), 1440) as int))"
END_TIME = f"{START_TIME} + make_dt_interval(0, 0, cast(minutes as int))"
STATUS = "case o_orderstatus when 'F' then 'completed' when 'O' then 'in_progress' else 'aborted' end"
# 10 to 50.
COMPLEXITY_TENTHS = "cast(10 + floor(discount * 4 / lines) as int)"
# Shared by the customers of one segment and nation, so there are namesakes.
SURGEON_NAME = "concat_ws(' ', 'Dr.', c_mktsegment, cast(c_nationkey as string))"
YEARS_EXPERIENCE = "case when c_acctbal < 9800 then cast(floor((c_acctbal + 1000) / 500) as int) end"
PROCEDURE_TYPE = "coalesce(concat('Type-', cast(pmod(size, 8) as string)), 'UNKNOWN')"
GENDER = "case pmod(size, 3) when 0 then 'Female' when 1 then 'Male' when 2 then 'Other' end"
METRIC = "try_cast(get_json_object(props, '$.k') as int)"


def robot_id(key: str) -> str:
    return f"concat('RBT-', lpad(cast({key} as string), 9, '0'))"


def facility_id(key: str) -> str:
    return f"concat('FAC-', lpad(cast({key} as string), 3, '0'))"


def procedure_id(key: str) -> str:
    return f"concat('PROC-', cast({key} as string))"


def date_key(time: str) -> str:
    return f"cast(year({time}) * 10000 + month({time}) * 100 + day({time}) as int)"


def time_key(time: str) -> str:
    return f"cast(hour({time}) * 10000 + minute({time}) * 100 as int)"


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem reduced to one row per order.

    Flags are aggregated as booleans, not text: text extremes would make Spark sort instead of hash.
    Percentages become whole numbers by a cast, because ROUND on a double is slow in a scan this wide.
    """
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.expr("min(l_suppkey) as robot"),
            F.expr("min(l_partkey) as part"),
            F.expr("sum(cast(l_quantity as int)) as minutes"),
            F.expr("sum(cast(l_discount * 100 + 0.5 as int)) as discount"),
            F.expr("sum(cast(l_tax * 100 + 0.5 as int)) as tax"),
            F.expr("count(*) as lines"),
            F.expr("min(l_returnflag = 'R') as all_r"),
            F.expr("max(l_returnflag = 'R') as any_r"),
            F.expr("max(l_returnflag = 'N') as any_n"),
            F.expr("max(l_linestatus = 'O') as any_open"),
            F.expr("max(cast(l_tax * 100 + 0.5 as int)) as high_tax"),
            F.expr("max(l_linenumber) as high_line"),
        )
    )


def dim_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as robot_key",
        f"{robot_id('s_suppkey')} as robot_id",
        "s_name as robot_serial_number",
        "concat('Model-', cast(pmod(s_suppkey, 7) as string)) as robot_model",
        "concat('Maker-', cast(pmod(s_suppkey, 3) as string)) as manufacturer",
        "s_nationkey as facility_key",
        "case when s_acctbal >= 1000 then 'operational' else 'maintenance' end as status",
        "s_acctbal >= 0 as is_current",
    )


def dim_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey as facility_key",
        f"{facility_id('n_nationkey')} as facility_id",
        "n_name as facility_name",
        "concat('City of ', n_name) as city",
        "r_name as state",
        "'USA' as country",
        "case pmod(n_nationkey, 3) when 0 then 'Teaching Hospital' when 1 then 'Private Hospital' "
        "else 'Regional Hospital' end as facility_type",
        "pmod(n_nationkey, 8) <> 7 as is_current",
    )


def dim_surgeons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey as surgeon_key",
        "c_name as surgeon_id",
        f"{SURGEON_NAME} as surgeon_name",
        "c_mktsegment as specialization",
        f"{YEARS_EXPERIENCE} as years_experience",
        "c_acctbal >= 0 as is_current",
    )


def orders(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    """`since` bounds the order date, so it reaches the scan."""
    df = read(spark, sf_dir, "orders")
    return df if since is None else df.filter(f"o_orderdate >= timestamp_ntz '{since} 00:00:00'")


def fact_procedures(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    homes = read(spark, sf_dir, "supplier").groupBy("s_suppkey").agg(F.expr("min(s_nationkey) as home"))
    parts = read(spark, sf_dir, "part").groupBy("p_partkey").agg(F.expr("min(p_size) as size"))
    return (
        orders(spark, sf_dir, since)
        .join(order_lines(spark, sf_dir), F.expr("o_orderkey = l_orderkey"), "left")
        .join(homes, F.expr("robot = s_suppkey"), "left")
        .join(parts, F.expr("part = p_partkey"), "left")
        .selectExpr(
            "o_orderkey as procedure_key",
            f"{procedure_id('o_orderkey')} as procedure_id",
            f"coalesce(robot, {UNKNOWN_KEY}) as robot_key",
            "o_custkey as surgeon_key",
            f"coalesce(home, {UNKNOWN_KEY}) as facility_key",
            f"{date_key('o_orderdate')} as start_date_key",
            f"{time_key(START_TIME)} as start_time_key",
            f"{date_key(END_TIME)} as end_date_key",
            f"{time_key(END_TIME)} as end_time_key",
            f"{PROCEDURE_TYPE} as procedure_type",
            "o_orderpriority as procedure_category",
            "concat('PAT-', cast(o_custkey as string)) as patient_id",
            "size * 2 as patient_age",
            f"{GENDER} as patient_gender",
            "cast(minutes as int) as duration_minutes",
            f"cast({COMPLEXITY_TENTHS} / 10 as decimal(3,1)) as complexity_score",
            "case when any_open then 'Complicated' when not any_open then 'Successful' end as success_status",
            "cast(tax * 10 as int) as blood_loss_ml",
            "case when all_r then 'Severe' when any_r then 'Moderate' when any_n then 'Minor' "
            "when lines is not null then 'None' end as complication_level",
            "cast(lines as int) as hospital_stay_days",
            "cast(high_line + 2 as decimal(3,1)) as patient_satisfaction_score",
            "high_tax >= 8 as readmission_30day",
            f"{STATUS} as status",
        )
    )


def fact_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: the user id is the procedure's key, the value a temperature, `props.k` the other metrics."""
    return (
        read(spark, sf_dir, "events")
        .withColumn("k", F.expr(METRIC))
        .selectExpr(
            "event_id as telemetry_key",
            "user_id as procedure_key",
            f"{time_key('ts')} as timestamp_key",
            "ts as sample_timestamp",
            "event_type as tool_type",
            "k >= 50 as tool_active",
            "cast(value as decimal(5,2)) as system_temperature",
            "cast(value / 100 as decimal(8,4)) as motor_current",
            "k + 10 as network_latency_ms",
            "cast(70 - floor(k / 2) as int) as video_fps",
        )
    )


def star(spark: SparkSession, sf_dir: str, since: date | None = None) -> Star:
    return Star(
        dim_date=lambda: dims.date_spine(spark, SPINE_START, SPINE_DAYS),
        dim_time=lambda: dims.time_spine(spark),
        dim_facilities=lambda: dim_facilities(spark, sf_dir),
        dim_surgeons=lambda: dim_surgeons(spark, sf_dir),
        dim_robots=lambda: dim_robots(spark, sf_dir),
        fact_procedures=lambda: fact_procedures(spark, sf_dir, since),
        fact_procedure_telemetry=lambda: fact_telemetry(spark, sf_dir),
    )
