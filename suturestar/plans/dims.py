"""Calendar, clock and facility dimensions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.functions import timekeys as tk
from suturestar.schemas import conform

SPINE_START = date(2020, 1, 1)
SPINE_DAYS = 3653

# The ten facility seed rows of the public data model.
FACILITY_SEED = [
    ("FAC-001", "Memorial Medical Center", "Boston", "MA", "USA", "Teaching Hospital", 850),
    ("FAC-002", "St. Mary's Hospital", "New York", "NY", "USA", "Private Hospital", 600),
    ("FAC-003", "Bay Area Surgical Institute", "San Francisco", "CA", "USA", "Specialty Center", 400),
    ("FAC-004", "Texas Medical Complex", "Houston", "TX", "USA", "Teaching Hospital", 900),
    ("FAC-005", "Pacific Northwest Regional", "Seattle", "WA", "USA", "Regional Hospital", 550),
    ("FAC-006", "Midwest Surgical Center", "Chicago", "IL", "USA", "Private Hospital", 700),
    ("FAC-007", "Florida Advanced Care", "Miami", "FL", "USA", "Specialty Center", 450),
    ("FAC-008", "Mountain View Hospital", "Denver", "CO", "USA", "Regional Hospital", 500),
    ("FAC-009", "Atlanta Healthcare System", "Atlanta", "GA", "USA", "Teaching Hospital", 800),
    ("FAC-010", "Desert Medical Institute", "Phoenix", "AZ", "USA", "Private Hospital", 600),
]
FACILITY_SEED_DATE = date(2020, 1, 1)


def days(spark: SparkSession, start: date, n_days: int) -> DataFrame:
    last = start + timedelta(days=n_days - 1)
    return spark.range(1, numPartitions=1).select(
        F.explode(F.sequence(F.lit(start), F.lit(last))).alias("date")
    )


def date_attributes(
    df: DataFrame, fiscal_start: int = 10, holiday: Callable[[Column], Column] = tk.us_holiday
) -> DataFrame:
    """Every dim_date column for the days in `df.date`."""
    d = F.col("date")
    dow = tk.weekday(d)
    return conform(
        df.select(
            tk.date_key(d).alias("date_key"),
            d,
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.weekofyear(d).alias("week"),
            F.dayofmonth(d).alias("day_of_month"),
            dow.alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            dow.isin(0, 6).alias("is_weekend"),
            holiday(d).alias("is_holiday"),
            tk.fiscal_year(d, fiscal_start).alias("fiscal_year"),
            tk.fiscal_quarter(d, fiscal_start).alias("fiscal_quarter"),
        ),
        "dim_date",
    )


def date_spine(
    spark: SparkSession,
    start: date = SPINE_START,
    n_days: int = SPINE_DAYS,
    fiscal_start: int = 10,
    holiday: Callable[[Column], Column] = tk.us_holiday,
) -> DataFrame:
    return date_attributes(days(spark, start, n_days), fiscal_start, holiday)


def time_spine(spark: SparkSession) -> DataFrame:
    minute_of_day = F.col("id")
    h = F.floor(minute_of_day / 60).cast("int")
    m = F.pmod(minute_of_day, F.lit(60)).cast("int")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return conform(
        spark.range(0, 24 * 60, numPartitions=1).select(
            (h * 10000 + m * 100).alias("time_key"),
            F.concat(two(h), F.lit(":"), two(m), F.lit(":00")).alias("time_value"),
            h.alias("hour"),
            m.alias("minute"),
            F.lit(0).alias("second"),
            (F.pmod(h + 11, F.lit(12)) + 1).alias("hour_12"),
            F.when(h < 12, "AM").otherwise("PM").alias("am_pm"),
            tk.day_part(h).alias("time_of_day"),
            ((h >= 8) & (h < 18)).alias("business_hours"),
        ),
        "dim_time",
    )


def facility_seed(spark: SparkSession) -> DataFrame:
    """The seed as a constant relation, known to the optimizer without a job."""
    text = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "\\'") + "'"
    values = ", ".join(f"({', '.join(map(text, row))})" for row in FACILITY_SEED)
    columns = "facility_id, facility_name, city, state, country, facility_type, bed_count"
    return spark.sql(f"select *, date '{FACILITY_SEED_DATE}' as effective_date from values {values} as t({columns})")
