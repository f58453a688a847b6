from datetime import date

import pytest
from pyspark.sql import functions as F

from suturestar.functions import measures as m
from suturestar.functions.lists import items
from suturestar.functions.timekeys import fiscal_quarter, fiscal_year, full_years, wall_clock
from suturestar.plans import dims
from suturestar.plans.reports import experience_band


def test_date_spine_has_ten_years(spark):
    rows = {r.date: r for r in dims.date_spine(spark).collect()}
    assert len(rows) == 3653
    assert max(rows) == date(2029, 12, 31)
    assert rows[date(2024, 2, 29)].date_key == 20240229
    assert (rows[date(2023, 9, 30)].fiscal_year, rows[date(2023, 9, 30)].fiscal_quarter) == (2023, 4)
    assert (rows[date(2023, 10, 1)].fiscal_year, rows[date(2023, 10, 1)].fiscal_quarter) == (2024, 1)
    holidays = {d for d, r in rows.items() if r.is_holiday and d.year in (2022, 2024)}
    assert holidays == {
        date(2022, 1, 1), date(2022, 7, 4), date(2022, 11, 24), date(2022, 12, 25),
        date(2024, 1, 1), date(2024, 7, 4), date(2024, 11, 28), date(2024, 12, 25),
    }
    sunday = rows[date(2024, 9, 1)]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend, sunday.month_name) == (0, "Sunday", True, "September")
    assert (rows[date(2021, 1, 1)].week, rows[date(2021, 1, 1)].quarter) == (53, 1)


def test_fiscal_start_is_a_parameter(spark):
    df = spark.sql("select date '2024-01-15' as d, date '2024-04-01' as e")
    row = df.select(
        fiscal_year(F.col("d"), 1), fiscal_quarter(F.col("d"), 1), fiscal_year(F.col("e"), 4), fiscal_quarter(F.col("e"), 4)
    ).first()
    assert tuple(row) == (2024, 1, 2025, 1)


def test_time_spine(spark):
    rows = {r.time_key: r for r in dims.time_spine(spark).collect()}
    assert len(rows) == 1440
    parts = {h: rows[h * 10000].time_of_day for h in (4, 5, 11, 12, 16, 17, 20, 21)}
    assert parts == {
        4: "Night", 5: "Morning", 11: "Morning", 12: "Afternoon", 16: "Afternoon", 17: "Evening", 20: "Evening", 21: "Night",
    }
    assert [rows[h * 10000].business_hours for h in (7, 8, 17, 18)] == [False, True, True, False]
    assert [rows[h * 10000].hour_12 for h in (0, 1, 12, 13, 23)] == [12, 1, 12, 1, 11]
    assert (rows[93500].time_value, rows[93500].am_pm, rows[120000].am_pm) == ("09:35:00", "AM", "PM")


def test_facility_seed(spark):
    rows = dims.facility_seed(spark).collect()
    assert len(rows) == 10
    assert rows[1].facility_name == "St. Mary's Hospital"


def test_bands(spark):
    df = spark.createDataFrame([(x,) for x in (4, 5, 9, 10, 14, 15, None)], "years_experience int")
    got = [r[0] for r in df.select(experience_band()).collect()]
    assert got == ["0-4 years", "5-9 years", "5-9 years", "10-14 years", "10-14 years", "15+ years", None]
    ages = spark.createDataFrame([(x,) for x in (29, 30, 49, 50, 64, 65, None)], "a int")
    band = m.bucket("a", [30, 50, 65], ["< 30", "30-49", "50-64", "65+"], otherwise="Unknown")
    assert [r[0] for r in ages.select(band).collect()] == [
        "< 30", "30-49", "30-49", "50-64", "50-64", "65+", "Unknown",
    ]
    with pytest.raises(ValueError):
        m.bucket("a", [1], ["only"])


def test_two_steps_equal_one(spark):
    df = spark.createDataFrame(
        [("a", 1, 10, True), ("a", 2, None, None), ("b", 1, 5, False), ("b", 1, 6, True), ("c", 3, None, None)],
        "g string, k int, x int, ok boolean",
    )
    measures = [
        m.rows("n"),
        m.average("avg_x", "x"),
        m.average_if("avg_ok", F.col("ok"), "x"),
        m.hours("h", "x"),
        m.hits("oks", F.col("ok")),
        m.rate("ok_pct", F.col("ok")),
        m.low("lo", "x"),
        m.high("hi", "x"),
    ]
    one = m.summarise(df, ["g"], measures).orderBy("g").collect()
    two = m.combine(m.partials(df, ["g", "k"], measures), ["g"], measures).orderBy("g").collect()
    assert one == two
    assert one[0] == ("a", 2, 10.0, 10.0, 10 / 60.0, 1, 50.0, 10, 10)
    assert one[2] == ("c", 1, None, None, None, 0, 0.0, None, None)
    empty = m.summarise(df.filter("false"), [], [m.rows("n"), m.rate("pct", F.col("ok"))]).first()
    assert tuple(empty) == (0, None)


def test_distinct_on_partials(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 2)], "r int, s int")
    measures = [m.distinct("rs", "r"), m.distinct("ss", "s"), m.rows("n")]
    assert tuple(m.combine(m.partials(df, ["r", "s"], measures), [], measures).first()) == (2, 2, 4)


def test_list_items(spark):
    df = spark.createDataFrame([("a, b",), ("none",), ("",), (None,), ("x.y, ,z",)], "t string")
    assert [r[0] for r in df.select(items(F.col("t"), ", ")).collect()] == [["a", "b"], ["none"], [], None, ["x.y", "z"]]


def test_wall_clock_ignores_offset(spark):
    df = spark.createDataFrame(
        [("2024-01-01T10:30:00Z",), ("2024-01-01T10:30:00+05:00",), ("2024-01-01 10:30:00.123",), ("bad",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(F.date_format(wall_clock(F.col("t")), "HH:mm:ss.SSS")).collect()]
    assert got == ["10:30:00.000", "10:30:00.000", "10:30:00.123", None, None]


def test_full_years_counts_like_an_age(spark):
    df = spark.sql("select date '2000-02-29' as a, date '2001-02-28' as b, date '2001-03-01' as c")
    row = df.select(full_years(F.col("a"), F.col("b")), full_years(F.col("a"), F.col("c"))).first()
    assert (row[0], row[1]) == (0, 1)
