"""Service queries on the operational tables, and the check queries."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suturestar.functions.measures import average, combine, distinct, partials, rows, summarise
from suturestar.functions.timekeys import moment
from suturestar.operators.quality import row_counts
from suturestar.plans.star import TABLES, Star
from suturestar.plans.views import (
    op_robot_utilization,
    vw_facility_performance,
    vw_robot_utilization,
    vw_robot_utilization_monthly,
    with_start_date,
)

Tables = Mapping[str, DataFrame]


def where_given(df: DataFrame, **values: object) -> DataFrame:
    """Equality filters for the values that are given; None or '' lifts one."""
    for column, value in values.items():
        if value is not None and value != "":
            df = df.filter(F.col(column) == value)
    return df


def page(df: DataFrame, order: list[Column | str], limit: int, offset: int = 0) -> DataFrame:
    """LIMIT/OFFSET over a total order; end `order` with a unique column."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


# Where a page ended: the last row's start time and id.
Token = tuple[datetime | None, str]


def last_of(page_rows: DataFrame) -> Token | None:
    """The token of a page, None for an empty one.  Collects the page's keys, which its limit bounds."""
    keys = page_rows.select("start_time", "procedure_id").collect()
    return tuple(keys[-1]) if keys else None


def beyond(token: Token) -> Column:
    """Rows after the token's in the order start_time DESC (NULL last), procedure_id."""
    start, id_ = token
    tie = F.col("procedure_id") > id_
    if start is None:
        return F.col("start_time").isNull() & tie
    at = moment(start)
    return (F.col("start_time") < at) | ((F.col("start_time") == at) & tie) | F.col("start_time").isNull()


def robots(tables: Tables, facility_id: str | None = None, status: str | None = None) -> DataFrame:
    return where_given(tables["surgical_robots"], facility_id=facility_id, status=status).orderBy(
        "facility_name", "robot_serial_number"
    )


def robot_detail(tables: Tables, robot_id: str) -> DataFrame:
    """The robot's row and its number of procedures; no row for an unknown id."""
    n = tables["surgical_procedures"].filter(F.col("robot_id") == robot_id).agg(F.count(F.lit(1)))
    return tables["surgical_robots"].filter(F.col("robot_id") == robot_id).withColumn("procedure_count", n.scalar())


def procedures(
    tables: Tables,
    robot_id: str | None = None,
    category: str | None = None,
    status: str | None = "completed",
    limit: int = 100,
    offset: int = 0,
    after: Token | None = None,
) -> DataFrame:
    """Newest first.  `status=''` lifts the default filter.

    `after`, the token of the page before, costs the same at any depth: a filter on the scan, and no task keeps more
    than `limit` rows.  `offset` keeps all rows before the page.
    """
    found = where_given(
        tables["surgical_procedures"], robot_id=robot_id, procedure_category=category, status=status
    )
    if after is not None:
        found = found.filter(beyond(after))
    return page(found, [F.desc("start_time"), "procedure_id"], limit, offset)


def procedure_detail(tables: Tables, procedure_id: str) -> DataFrame:
    """The procedure with its robot's model and facility, and its outcome as a struct (NULL for none)."""
    mine = F.col("procedure_id") == procedure_id
    fleet = tables["surgical_robots"].select("robot_id", "robot_model", "facility_name")
    outcome = tables["procedure_outcomes"].filter(mine)
    packed = outcome.select("procedure_id", F.struct(*outcome.columns).alias("outcome"))
    return (
        tables["surgical_procedures"].filter(mine).join(fleet, "robot_id").join(packed, "procedure_id", "left")
    )


def outcomes(tables: Tables, success_status: str | None = None, limit: int = 100) -> DataFrame:
    parents = tables["surgical_procedures"].select("procedure_id", "procedure_type", "start_time")
    found = where_given(tables["procedure_outcomes"], success_status=success_status)
    return page(found.join(parents, "procedure_id"), [F.desc("start_time"), "procedure_id"], limit)


def robot_utilization(tables: Tables) -> DataFrame:
    return op_robot_utilization(tables).orderBy(F.desc("procedure_count"), "robot_id")


def _outcome_profile(outcomes_table: DataFrame, count: str, stay: str) -> DataFrame:
    return summarise(
        outcomes_table,
        ["success_status"],
        [
            rows(count),
            average("avg_blood_loss", "blood_loss_ml"),
            average(stay, "hospital_stay_days"),
            average("avg_satisfaction", "patient_satisfaction_score"),
        ],
    )


def outcome_summary(tables: Tables) -> DataFrame:
    return _outcome_profile(tables["procedure_outcomes"], "count", "avg_stay_days")


def _category_profile(procedures_table: DataFrame, count: str) -> DataFrame:
    return summarise(
        procedures_table,
        ["procedure_category"],
        [rows(count), average("avg_duration", "duration_minutes"), average("avg_complexity", "complexity_score")],
    ).orderBy(F.desc(count), "procedure_category")


def category_stats(tables: Tables, as_of: datetime, days: int = 30) -> DataFrame:
    since = moment(as_of - timedelta(days=days))
    return _category_profile(tables["surgical_procedures"].filter(F.col("start_time") >= since), "count")


def ingest_stats(tables: Tables) -> DataFrame:
    """Counted per robot first, so the distinct count needs no second copy of the rows."""
    per_robot = tables["surgical_procedures"].groupBy("robot_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("start_time").alias("latest")
    )
    return per_robot.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_procedures"),
        F.count("robot_id").alias("unique_robots"),
        F.max("latest").alias("latest_procedure"),
    )


def check_counts(tables: Tables) -> DataFrame:
    return row_counts(tables)


def check_models(tables: Tables) -> DataFrame:
    """Robots and procedures per model, models without procedures too."""
    per_robot = tables["surgical_procedures"].groupBy("robot_id").agg(F.count("procedure_id").alias("n"))
    fleet = tables["surgical_robots"].select("robot_id", "robot_model")
    return (
        fleet.join(per_robot, "robot_id", "left")
        .groupBy("robot_model")
        .agg(F.count_distinct("robot_id").alias("robot_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_procedures"))
        .orderBy(F.desc("total_procedures"), "robot_model")
    )


def check_categories(tables: Tables) -> DataFrame:
    return _category_profile(tables["surgical_procedures"].filter(F.col("status") == "completed"), "procedure_count")


def check_outcomes(tables: Tables) -> DataFrame:
    return _outcome_profile(tables["procedure_outcomes"], "outcome_count", "avg_stay").orderBy(
        F.desc("outcome_count"), "success_status"
    )


def warehouse_counts(star: Star) -> DataFrame:
    return row_counts({t: getattr(star, t) for t in TABLES}).orderBy("table_name")


def dashboard(star: Star, as_of, days: int = 30) -> DataFrame:
    """The reduced dashboard: robots of any version."""
    measures = [
        rows("total_procedures"),
        distinct("active_robots", "robot_key"),
        average("avg_duration", "duration_minutes", 2),
        average("avg_satisfaction", "patient_satisfaction_score", 2),
    ]
    recent = with_start_date(star, star.completed_since(as_of - timedelta(days=days)))
    per_robot = partials(recent, ["robot_key"], measures)
    return combine(per_robot.join(star.dim_robots.select("robot_key"), "robot_key"), [], measures)


def top_facilities(star: Star, n: int = 10) -> DataFrame:
    return (
        vw_facility_performance(star)
        .orderBy(F.desc("success_rate"), F.desc("avg_patient_satisfaction"), "facility_id")
        .limit(n)
    )


def top_robots(star: Star, n: int = 10) -> DataFrame:
    return vw_robot_utilization(star).orderBy(F.desc("total_procedures"), "robot_id").limit(n)


def utilization_in_year(star: Star, year: int) -> DataFrame:
    return vw_robot_utilization_monthly(star).filter(F.col("year") == year).orderBy("year", "month", "robot_id")
