"""Calendar and clock keys as plain column expressions (all stay inside codegen)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer; NULL in, NULL out."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def time_key(c: Column) -> Column:
    """hhmm00 as an integer (hour * 10000 + minute * 100)."""
    return (F.hour(c) * 10000 + F.minute(c) * 100).cast("int")


def moment(value: date | datetime) -> Column:
    """A wall-clock literal, the same in every session zone."""
    return F.lit(value.isoformat()).cast("timestamp_ntz")


def date_key_literal(d: date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def weekday(c: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(c) - 1


def fiscal_year(c: Column, start_month: int = 10) -> Column:
    if start_month == 1:
        return F.year(c)
    return F.year(c) + F.when(F.month(c) >= start_month, 1).otherwise(0)


def fiscal_quarter(c: Column, start_month: int = 10) -> Column:
    months_in = F.pmod(F.month(c) - F.lit(start_month), F.lit(12))
    return (F.floor(months_in / 3) + 1).cast("int")


def us_holiday(c: Column) -> Column:
    """New Year's Day, Independence Day, Christmas Day and the fourth Thursday of November."""
    month, day = F.month(c), F.dayofmonth(c)
    fixed = ((month == 1) & (day == 1)) | ((month == 7) & (day == 4)) | ((month == 12) & (day == 25))
    thanksgiving = (month == 11) & (weekday(c) == 4) & day.between(22, 28)
    return fixed | thanksgiving


def day_part(hour: Column) -> Column:
    return (
        F.when((hour >= 5) & (hour < 12), "Morning")
        .when((hour >= 12) & (hour < 17), "Afternoon")
        .when((hour >= 17) & (hour < 21), "Evening")
        .otherwise("Night")
    )


def full_years(since: Column, until: Column) -> Column:
    """Whole years between two dates, as an age is counted: 29 February turns on 1 March of a common year."""
    before = F.struct(F.month(until), F.dayofmonth(until)) < F.struct(F.month(since), F.dayofmonth(since))
    return F.year(until) - F.year(since) - before.cast("int")


def wall_clock(text: Column) -> Column:
    """Timestamp text as written, its offset dropped; NULL when it does not parse."""
    return text.try_cast("timestamp_ntz")
