"""Views and reports on a small star with answers worked out by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from suturestar.plans import dims, lookups, reports, views
from suturestar.plans.star import Star
from suturestar.schemas import conform, schema_of

NOW = datetime(2024, 1, 1)
AS_OF = date(2024, 3, 31)


def table(spark, name, columns, rows):
    kinds = {f.name: f.dataType.simpleString() for f in schema_of(name).fields}
    ddl = ", ".join(f"{c} {kinds[c]}" for c in columns)
    return conform(spark.createDataFrame(rows, ddl), name, NOW)


@pytest.fixture(scope="module")
def star(spark):
    d = Decimal
    robots = table(
        spark,
        "dim_robots",
        ["robot_key", "robot_id", "robot_serial_number", "robot_model", "manufacturer", "facility_key", "effective_date", "is_current"],
        [
            (1, "R1", "S1", "M1", "X", 1, date(2020, 1, 1), True),
            (2, "R2", "S2", "M1", "X", 1, date(2020, 1, 1), True),
            (3, "R3", "S3", "M2", "Y", 2, date(2020, 1, 1), True),
            (4, "R1", "S1", "M1", "X", 1, date(2019, 1, 1), False),
            (5, "R5", "S5", "M2", "Y", None, date(2020, 1, 1), True),
        ],
    )
    facilities = table(
        spark,
        "dim_facilities",
        ["facility_key", "facility_id", "facility_name", "city", "state", "facility_type", "effective_date", "is_current"],
        [
            (1, "F1", "North", "C1", "S1", "Teaching Hospital", date(2020, 1, 1), True),
            (2, "F2", "South", "C2", "S2", "Private Hospital", date(2020, 1, 1), False),
        ],
    )
    surgeons = table(
        spark,
        "dim_surgeons",
        ["surgeon_key", "surgeon_id", "surgeon_name", "specialization", "years_experience", "effective_date", "is_current"],
        [
            (1, "D1", "Ann", "G", 4, date(2020, 1, 1), True),
            (2, "D2", "Ann", "G", 10, date(2020, 1, 1), True),
            (3, "D3", "Cy", "G", None, date(2020, 1, 1), True),
            (4, "D4", "Old", "G", 20, date(2019, 1, 1), False),
        ],
    )
    columns = [
        "procedure_key", "procedure_id", "robot_key", "surgeon_key", "facility_key", "start_date_key", "start_time_key",
        "procedure_type", "procedure_category", "patient_age", "patient_gender", "duration_minutes", "complexity_score",
        "success_status", "blood_loss_ml", "complication_level", "hospital_stay_days", "patient_satisfaction_score",
        "readmission_30day", "status",
    ]
    procedures = table(
        spark,
        "fact_procedures",
        columns,
        [
            (1, "P1", 1, 1, 1, 20240301, 93000, "T1", "C1", 29, "F", 60, d("2.0"), "Successful", 100, "None", 2, d("9.0"), False, "completed"),
            (2, "P2", 1, 2, 1, 20240305, 123000, "T1", "C1", 30, "F", 90, d("3.0"), "Complicated", 200, "Moderate", 4, d("5.0"), True, "completed"),
            (3, "P3", 2, 1, 1, 20231001, 180000, "T2", "C2", 65, "M", 30, d("1.5"), "Successful", None, "Minor", 1, None, None, "completed"),
            (4, "P4", 3, 3, 2, 20240305, 50000, "T2", "C2", 64, None, 120, d("4.0"), "Failed", 900, "Severe", 9, d("2.0"), True, "completed"),
            (5, "P5", 1, 1, 1, 20240310, 230000, "T1", "C1", None, "F", 45, d("2.0"), None, None, None, None, None, None, "aborted"),
            (6, "P6", 4, 4, 1, 20231231, 93000, "T1", "C1", 49, "M", 15, d("1.0"), "Successful", 10, "None", 1, d("10.0"), False, "completed"),
            (7, "P7", -1, -1, -1, 20240302, 93000, "T1", "C1", 50, "M", 75, d("2.5"), "Successful", 50, "None", 1, d("8.0"), False, "completed"),
        ],
    )
    t = datetime(2024, 3, 1, 9, 30)
    telemetry = table(
        spark,
        "fact_procedure_telemetry",
        ["telemetry_key", "procedure_key", "timestamp_key", "sample_timestamp", "system_temperature", "motor_current",
         "network_latency_ms", "video_fps"],
        [
            (1, 1, 93000, t, d("75.00"), d("1.0"), 100, 25),
            (2, 1, 93100, t.replace(minute=31), d("75.01"), None, 100, 25),
            (3, 1, 93200, t.replace(minute=32), None, d("2.0"), 101, None),
            (4, 2, 93000, t, d("50.00"), d("1.0"), 10, 24),
            (5, 3, 93000, t, None, None, None, None),
        ],
    )
    return Star(
        dim_date=dims.date_spine(spark), dim_time=dims.time_spine(spark), dim_facilities=facilities,
        dim_surgeons=surgeons, dim_robots=robots, fact_procedures=procedures, fact_procedure_telemetry=telemetry,
    )


def by(df, *keys):
    rows = [r.asDict() for r in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}


def test_robot_utilization(star):
    rows = by(views.vw_robot_utilization(star), "robot_id")
    assert set(rows) == {"R1", "R2"}  # R3's facility and R1's old version are not current
    r1 = rows["R1"]
    assert (r1["total_procedures"], r1["total_operating_hours"], r1["days_in_operation"]) == (3, 195 / 60, 10)
    assert (r1["first_procedure_date"], r1["last_procedure_date"]) == (date(2024, 3, 1), date(2024, 3, 10))
    assert r1["procedures_per_day"] == 3 / 10 and r1["avg_procedure_duration_minutes"] == 65.0
    monthly = by(views.vw_robot_utilization_monthly(star), "robot_id", "year", "month")
    assert set(monthly) == {("R1", 2024, 3), ("R2", 2023, 10), ("R3", 2024, 3)}
    assert monthly["R3", 2024, 3]["operating_hours"] == 2.0


def test_outcomes(star):
    rows = by(views.vw_procedure_outcomes(star), "procedure_type")
    t1, t2 = rows["T1"], rows["T2"]
    assert (t1["total_procedures"], t1["successful_count"], t1["success_rate"]) == (4, 3, 75.0)
    assert (t1["complication_count"], t1["readmission_count"], t1["readmission_rate"]) == (1, 1, 25.0)
    assert (t2["avg_blood_loss_ml"], t2["avg_satisfaction_score"], t2["readmission_rate"]) == (900.0, 2.0, 50.0)
    models = by(views.vw_outcomes_by_robot_model(star), "robot_model")
    assert models["M1"]["total_procedures"] == 3 and models["M1"]["no_complication_rate"] == pytest.approx(100 / 3)
    q4 = by(reports.q04_complications_by_type(star), "procedure_type")
    assert [q4["T1"][c] for c in ("no_complications", "moderate_complications", "serious_complication_rate_pct")] == [3, 1, 25.0]
    q6 = by(reports.q06_readmission_by_category(star), "procedure_category")
    assert (q6["C1"]["avg_stay_with_readmission"], q6["C1"]["avg_stay_no_readmission"]) == (4.0, 1.33)
    assert q6["C2"]["avg_stay_no_readmission"] is None


def test_surgeons(star):
    rows = by(views.vw_surgeon_performance(star), "surgeon_id")
    assert set(rows) == {"D1", "D2", "D3"}
    assert rows["D1"]["no_readmission_rate"] == 100.0  # FALSE and NULL both count
    names = by(views.vw_surgeon_procedure_categories(star), "surgeon_name", "procedure_category")
    assert names["Ann", "C1"]["procedure_count"] == 2  # namesakes merge
    assert reports.q07_top_surgeons(star).isEmpty()
    top = reports.q07_top_surgeons(star, at_least=2).collect()
    assert [(r.surgeon_name, r.years_experience, r.success_rate_pct) for r in top] == [("Ann", 4, 100.0)]
    bands = by(reports.q08_experience_bands(star), "experience_group")
    assert set(bands) == {"0-4 years", "10-14 years", None}
    assert (bands["0-4 years"]["surgeon_count"], bands["0-4 years"]["procedure_count"]) == (1, 2)


def test_facilities(star):
    rows = by(views.vw_facility_performance(star), "facility_id")
    assert set(rows) == {"F1"}
    assert [rows["F1"][c] for c in ("robot_count", "total_procedures", "surgeon_count")] == [2, 3, 2]
    q9 = by(reports.q09_facility_comparison(star), "facility_name")
    assert (q9["North"]["robot_count"], q9["North"]["avg_satisfaction"]) == (2, 7.0)
    q10 = by(reports.q10_facility_efficiency(star, AS_OF), "facility_name")["North"]
    assert (q10["robot_count"], q10["operating_days"], q10["potential_capacity_hours"]) == (1, 2, 16)
    assert (q10["actual_operating_hours"], q10["utilization_rate_pct"]) == (2.5, 15.63)


def test_time(star):
    daily = by(views.vw_daily_procedure_volume(star), "date")
    assert daily[date(2024, 3, 5)]["procedure_count"] == 2 and daily[date(2023, 10, 1)]["is_weekend"]
    parts = by(views.vw_procedures_by_time_of_day(star), "time_of_day", "business_hours")
    assert {k: r["procedure_count"] for k, r in parts.items()} == {
        ("Morning", True): 3, ("Afternoon", True): 1, ("Evening", False): 1, ("Morning", False): 1,
    }
    assert [r.time_of_day for r in reports.q13_time_of_day(star).collect()] == ["Morning", "Afternoon", "Evening"]
    growth = [(r.year, r.quarter, r.prev_period_count, r.growth_rate_pct) for r in reports.q14_period_growth(star).collect()]
    assert growth == [(2023, 4, None, None), (2024, 1, 2, 100.0)]
    q3 = [(r.year_month, r.procedure_count) for r in reports.q03_monthly_trend(star, AS_OF).collect()]
    assert q3 == [("2023-10", 1), ("2023-12", 1), ("2024-03", 4)]
    q12 = by(reports.q12_day_of_week(star, AS_OF), "day_name")
    assert q12["Tuesday"]["procedure_count"] == 2 and set(q12) == {"Tuesday", "Friday", "Saturday"}


def test_ages(star):
    rows = by(views.vw_outcomes_by_demographics(star), "patient_gender", "age_group")
    assert set(rows) == {("F", "< 30"), ("F", "30-49"), ("M", "65+"), (None, "50-64"), ("M", "30-49"), ("M", "50-64")}
    q15 = by(reports.q15_age_cohorts(star), "age_group", "procedure_category")
    assert q15["Under 30", "C1"]["avg_complexity"] == 2.0


def test_dashboard(star):
    q1 = reports.q01_platform_metrics(star, AS_OF).first()
    assert (q1.total_procedures, q1.active_robots, q1.active_surgeons, q1.active_facilities) == (2, 1, 2, 1)
    assert (q1.avg_procedure_duration_min, q1.total_operating_hours, q1.success_rate_pct) == (75.0, 2.5, 50.0)
    c7 = lookups.dashboard(star, AS_OF).first()
    assert (c7.total_procedures, c7.active_robots) == (3, 2)
    empty = reports.q01_platform_metrics(star, date(2010, 1, 1), days=0)
    assert reports.q01_platform_metrics(star, date(2031, 1, 1)).first().success_rate_pct is None and empty.count() == 1
    q2 = reports.q02_top_robots(star).collect()
    assert [(r.robot_id, r.procedure_count) for r in q2] == [("R1", 2), ("R2", 1)]
    assert reports.q05_outcomes_by_model(star).isEmpty()
    assert reports.q05_outcomes_by_model(star, at_least=3).count() == 1


def test_telemetry(star):
    health = by(views.vw_telemetry_system_health(star), "procedure_id")
    p1 = health["P1"]
    assert (p1["telemetry_sample_count"], p1["avg_motor_current"], p1["max_network_latency"]) == (3, 1.5, 101)
    assert p1["max_temperature"] == Decimal("75.01") and health["P3"]["avg_temperature"] is None
    q11 = by(reports.q11_robot_health(star, at_least=1), "robot_id")
    assert (q11["R1"]["procedure_count"], q11["R1"]["warning_count"]) == (2, 3)
    assert q11["R2"]["warning_count"] == 0  # NULL metrics warn of nothing
    assert reports.q11_robot_health(star).isEmpty()


def test_all_versions_of_a_robot(star):
    rows = by(views.robot_utilization_all_versions(star), "robot_id")
    assert (rows["R1"]["total_procedures"], rows["R1"]["version_count"]) == (4, 2)


def test_sql_views(spark, star):
    star.register(spark)
    assert spark.sql("select count(*) from fact_procedures p join dim_robots r using (robot_key)").first()[0] == 6
