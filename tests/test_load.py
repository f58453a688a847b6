"""The whole load on hand-made operational tables, CSV sources included."""

import glob
import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from suturestar.operators import quality
from suturestar.plans import etl, load, lookups, views
from suturestar.schemas import conform
from suturestar.sources import readers, snapshots, writers

NOW = datetime(2024, 6, 1)
ROBOTS = """robot_id,robot_serial_number,robot_model,manufacturer,installation_date,facility_id,facility_name,status,last_maintenance_date,total_procedures,firmware_version,created_at,updated_at
r1,INT-1,M1,X,2022-01-01,FAC-001,"Memorial, North",operational,2024-01-01,0,v1,2024-01-01 00:00:00,2024-01-01 00:00:00
r2,INT-2,M1,X,2022-02-01,FAC-099,Elsewhere,maintenance,,0,,2024-01-01 00:00:00,2024-01-01 00:00:00
"""
PROCEDURES = """procedure_id,robot_id,procedure_type,procedure_category,start_time,end_time,duration_minutes,surgeon_id,surgeon_name,patient_id,patient_age,patient_gender,complexity_score,status,created_at
p1,r1,T,C,2024-05-01 00:00:00,2024-05-01 01:30:00,90,s1,Ann,x1,40,Female,4.55,completed,2024-05-01 00:00:00
p2,r1,T,C,2024-05-31 23:59:00,2024-06-01 00:29:00,30,s2,Bob,x2,50,,2.00,completed,2024-05-01 00:00:00
p3,r1,T,C,2024-06-01 00:00:00,2024-06-01 01:00:00,60,s1,Ann,x3,60,Male,3.00,aborted,2024-05-01 00:00:00
p4,rX,T,C,2024-05-10 10:00:00,2024-05-10 11:00:00,60,s1,Ann,x3,60,Male,3.00,completed,2024-05-01 00:00:00
"""
OUTCOMES = """outcome_id,procedure_id,success_status,blood_loss_ml,complications,hospital_stay_days,readmission_30day,patient_satisfaction_score,surgeon_notes,recovery_score,follow_up_required,created_at,updated_at
o1,p1,complicated,100,"bleeding, infection",3,true,7,"a ""quoted"" note",80,false,2024-05-01 00:00:00,2024-05-01 00:00:00
o2,p2,successful,,none,1,,9,,90,,2024-05-01 00:00:00,2024-05-01 00:00:00
"""
MAINTENANCE = """maintenance_id,robot_id,maintenance_date,maintenance_type,technician_id,technician_name,issues_found,actions_taken,parts_replaced,downtime_hours,next_maintenance_date,cost,created_at
m1,r1,2024-01-01,routine,t1,Tim,,clean; test,,1.50,2024-04-01,100.25,2024-01-01 00:00:00
m2,r1,2024-02-01,emergency,t1,Tim,,fix,,,,,2024-01-01 00:00:00
"""
WINDOW = (date(2024, 5, 1), date(2024, 6, 1))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("csv")
    for name, text in (
        ("surgical_robots", ROBOTS), ("surgical_procedures", PROCEDURES), ("procedure_outcomes", OUTCOMES),
        ("robot_maintenance_logs", MAINTENANCE),
    ):
        (root / f"{name}.csv").write_text(text)
    return readers.read_operational(spark, str(root), "csv")


def test_csv_types(tables):
    robots = {r.robot_id: r for r in tables["surgical_robots"].collect()}
    assert robots["r1"].facility_name == "Memorial, North" and robots["r2"].last_maintenance_date is None
    assert robots["r1"].installation_date == date(2022, 1, 1)
    p = tables["surgical_procedures"].filter("procedure_id = 'p2'").first()
    assert (p.start_time, p.patient_gender, p.duration_minutes) == (datetime(2024, 5, 31, 23, 59), None, 30)
    defaults = {r.outcome_id: r for r in conform(tables["procedure_outcomes"], "procedure_outcomes", NOW).collect()}
    assert (defaults["o2"].readmission_30day, defaults["o1"].readmission_30day) == (False, True)


def test_extracts(spark, tables):
    surgeons = {r.surgeon_id: r for r in etl.extract_surgeons(tables["surgical_procedures"], date(2026, 4, 30)).collect()}
    assert (surgeons["s1"].years_experience, surgeons["s1"].effective_date) == (1, date(2024, 5, 1))
    robots = {r.robot_id: r for r in etl.extract_robots(tables["surgical_robots"], tables["surgical_procedures"]).collect()}
    assert (robots["r1"].total_procedures_count, float(robots["r1"].total_operating_hours)) == (3, 3.0)
    assert (robots["r2"].total_procedures_count, float(robots["r2"].total_operating_hours)) == (0, 0.0)
    stage = etl.extract_procedures(
        tables["surgical_procedures"], tables["surgical_robots"], tables["procedure_outcomes"], *WINDOW
    )
    rows = {r.procedure_id: r for r in stage.collect()}
    assert set(rows) == {"p1", "p2", "p4"}  # the window's start is in, its end is out
    assert (float(rows["p1"].complexity_score), rows["p1"].success_status, rows["p1"].complication_level) == (4.6, "Complicated", "Moderate")
    assert (rows["p2"].start_time_key, rows["p2"].end_date_key, rows["p2"].end_time_key) == (235900, 20240601, 2900)
    assert (rows["p2"].complication_level, rows["p4"].success_status, rows["p4"].facility_id) == ("None", None, None)
    assert etl.window_of(None, None, date(2024, 6, 2)) == (date(2024, 6, 1), date(2024, 6, 2))


def report(df):
    return {r.stage: (r.status, r.inserted, r.closed, r.rejected) for r in df.collect()}


def test_full_load_twice(spark, tables, tmp_path):
    root = str(tmp_path)
    run = lambda kind="full", **kw: report(
        load.run_pipeline(spark, tables, root, kind, *WINDOW, as_of=date(2024, 6, 1), now=NOW, **kw)
    )
    first = run()
    assert first["facilities"] == ("SUCCESS", 2, 0, 0) and first["surgeons"] == ("SUCCESS", 2, 0, 0)
    assert first["robots"] == ("SUCCESS", 2, 0, 0)
    assert first["procedures"] == ("SUCCESS", 3, 0, 1)  # p4's robot, and so its facility, is unknown
    assert run()["total"] == ("SUCCESS", 0, 0, 0)
    assert report(load.run_pipeline(spark, tables, root, "procedures", date(2024, 6, 1), date(2024, 7, 1), as_of=date(2024, 6, 1)))[
        "procedures"
    ] == ("SUCCESS", 1, 0, 0)
    star = load.load_star(spark, root)
    fact = star.fact_procedures
    assert fact.count() == 4 and fact.select("procedure_key").distinct().count() == 4
    assert {r.start_month for r in fact.select("start_month").collect()} == {202405, 202406}
    unknown = fact.filter("procedure_id = 'p4'").first()
    assert (unknown.robot_key, unknown.facility_key) == (-1, -1) and unknown.surgeon_key > 0
    assert {r.table_name: r.row_count for r in lookups.warehouse_counts(star).collect()} == {
        "dim_date": 3653, "dim_time": 1440, "dim_facilities": 2, "dim_surgeons": 2, "dim_robots": 2,
        "fact_procedures": 4, "fact_procedure_telemetry": 0,
    }
    boston = star.dim_facilities.filter("facility_id = 'FAC-001'").first()
    assert (boston.city, boston.facility_name) == ("Boston", "Memorial, North")

    changed = dict(tables)
    changed["surgical_robots"] = tables["surgical_robots"].withColumn(
        "status", F.when(F.col("robot_id") == "r1", "retired").otherwise(F.col("status"))
    )
    later = report(load.run_pipeline(spark, changed, root, "dimensions", as_of=date(2024, 7, 1), now=NOW))
    assert later["robots"] == ("SUCCESS", 1, 1, 0)
    robots = load.load_star(spark, root).dim_robots
    assert robots.count() == 3 and quality.version_overlaps(robots, "robot_id").isEmpty()
    assert len(snapshots.committed(spark, root, "dim_robots")) == 3
    every = report(load.run_pipeline(spark, changed, root, "dimensions", as_of=date(2024, 8, 1), robot_mode="reference"))
    assert every["robots"] == ("SUCCESS", 2, 2, 0)


def test_failures(spark, tables, tmp_path):
    broken = spark.range(1).select(F.raise_error(F.lit("no telemetry today")).cast("string").alias("procedure_id"))
    partial = report(
        load.run_pipeline(spark, tables, str(tmp_path / "a"), "full", *WINDOW, as_of=date(2024, 6, 1), telemetry=broken)
    )
    assert partial["total"][0] == "PARTIAL_SUCCESS" and partial["telemetry"][0] == "FAILED" and partial["procedures"][1] == 3
    bad = {**tables, "surgical_procedures": tables["surgical_procedures"].withColumn("start_time", F.raise_error(F.lit("down")).cast("timestamp_ntz"))}
    failed = report(load.run_pipeline(spark, bad, str(tmp_path / "b"), "full", *WINDOW, as_of=date(2024, 6, 1)))
    assert failed["total"][0] == "FAILED" and "procedures" not in failed
    with pytest.raises(ValueError):
        load.run_pipeline(spark, tables, str(tmp_path), "weekly")


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    snapshots.write_snapshot(spark.range(3), root, "dim_robots")
    spark.range(9).write.parquet(f"{root}/dim_robots/snapshot=00000002")
    (tmp_path / "dim_robots" / "snapshot=00000002" / "_SUCCESS").unlink()
    assert snapshots.read_snapshot(spark, root, "dim_robots").count() == 3
    assert snapshots.write_snapshot(spark.range(4), root, "dim_robots") == "00000002"
    assert snapshots.read_snapshot(spark, root, "dim_robots").count() == 4


def test_lookups(spark, tables):
    assert lookups.robot_detail(tables, "r1").first().procedure_count == 3
    assert lookups.robot_detail(tables, "nobody").isEmpty()
    ids = lambda df: [r.procedure_id for r in df.collect()]
    assert ids(lookups.procedures(tables)) == ["p2", "p4", "p1"]
    assert ids(lookups.procedures(tables, status="", limit=2, offset=1)) == ["p2", "p4"]
    detail = lookups.procedure_detail(tables, "p1").first()
    assert detail.outcome.outcome_id == "o1" and detail.robot_model == "M1"
    assert lookups.procedure_detail(tables, "p3").first().outcome is None
    assert [r.outcome_id for r in lookups.outcomes(tables).collect()] == ["o2", "o1"]
    costs = {r.robot_id: r for r in views.op_maintenance_costs(tables).collect()}
    assert (costs["r1"].maintenance_count, float(costs["r1"].total_cost), costs["r1"].avg_cost) == (2, 100.25, 100.25)
    assert (costs["r2"].maintenance_count, costs["r2"].total_cost) == (0, None)
    body = writers.envelope(lookups.procedures(tables, limit=2), 2, 0, [F.desc("start_time"), "procedure_id"]).first()
    assert body["count"] == 2 and body.body.index("p2") < body.body.index("p4")


def test_untracked_attributes_are_refreshed(spark, tables, tmp_path):
    """A counter that is not versioned follows the snapshot without a new version."""
    from suturestar.operators.scd import scd2_merge

    dim = spark.createDataFrame(
        [("r1", "ok", 5, date(2024, 1, 1), None, True)],
        "robot_id string, status string, uses int, effective_date date, expiration_date date, is_current boolean",
    )
    fresh = spark.createDataFrame([("r1", "ok", 50)], "robot_id string, status string, uses int")
    got = scd2_merge(dim, fresh, "robot_id", ["status"], date(2024, 2, 1)).collect()
    assert [(r.uses, r.effective_date, r.is_current) for r in got] == [(50, date(2024, 1, 1), True)]


def test_calendar_covers_old_facts(spark, tables, tmp_path):
    root = str(tmp_path)
    old = dict(tables)
    shift = lambda c: (F.col(c) - F.expr("interval 30 years")).alias(c)
    old["surgical_procedures"] = tables["surgical_procedures"].withColumns({c: shift(c) for c in ("start_time", "end_time")})
    load.run_pipeline(spark, old, root, "full", date(1994, 1, 1), date(1995, 1, 1), as_of=date(1994, 6, 1), now=NOW)
    star = load.load_star(spark, root)
    assert star.fact_procedures.count() > 0
    per_day = views.vw_daily_procedure_volume(star)
    done = star.completed().count()
    assert done > 0 and per_day.agg(F.sum("procedure_count")).first()[0] == done
    assert star.dim_date.agg(F.min("date"), F.max("date")).first() == (date(1994, 1, 1), date(2029, 12, 31))
    assert load.load_star(spark, root, date(2024, 1, 1), 10).dim_date.count() == 10


def test_windowed_reports_prune_months(spark, tables, tmp_path):
    from suturestar.plans import reports

    root = str(tmp_path)
    load.run_pipeline(spark, tables, root, "full", *WINDOW, as_of=date(2024, 6, 1), now=NOW)
    star = load.load_star(spark, root)
    for plan in (reports.q12_day_of_week(star, date(2024, 6, 2)), lookups.dashboard(star, date(2024, 6, 2))):
        text = plan._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(start_month" in text


def test_an_append_without_rows_blocks_nothing(spark, tables, tmp_path):
    root = str(tmp_path)
    empty = load.run_pipeline(spark, tables, root, "full", date(2000, 1, 1), date(2000, 1, 2), as_of=date(2024, 6, 1), now=NOW)
    assert report(empty)["procedures"][:2] == ("SUCCESS", 0)
    again = load.run_pipeline(spark, tables, root, "full", *WINDOW, as_of=date(2024, 6, 1), now=NOW)
    assert report(again)["procedures"][:2] == ("SUCCESS", 3)


def test_old_snapshots_can_be_dropped(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2, 3):
        snapshots.write_snapshot(spark.range(n), root, "dim_robots")
    assert snapshots.drop_old(spark, root, "dim_robots") == ["00000001"]
    assert snapshots.read_snapshot(spark, root, "dim_robots").count() == 3


def test_facts_are_deduplicated_without_a_sort_of_their_own(spark, tables, tmp_path):
    """Rows that the join with the outcomes has sorted by procedure are not sorted once more by all columns."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stage = etl.extract_procedures(
            tables["surgical_procedures"].unionByName(tables["surgical_procedures"]), tables["surgical_robots"], tables["procedure_outcomes"], *WINDOW
        )
        fresh, _ = etl.stage_facts(stage, load.load_star(spark, str(tmp_path)), load.read_table(spark, str(tmp_path), load.PROCEDURES))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and sorted(r.procedure_id for r in fresh.collect()) == ["p1", "p2", "p4"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_a_repeated_load_extracts_once_and_leaves_nothing_staged(spark, tables, tmp_path, monkeypatch):
    root, read = str(tmp_path), []
    seen = load.etl.stage_facts
    monkeypatch.setattr(load.etl, "stage_facts", lambda stage, *rest: read.append(stage.inputFiles()) or seen(stage, *rest))
    for _ in range(2):
        load.run_pipeline(spark, tables, root, "full", *WINDOW, as_of=date(2024, 6, 1), now=NOW)
    assert not any("staged_procedures" in f for f in read[0]) and all("staged_procedures" in f for f in read[1])
    assert load.read_table(spark, root, load.PROCEDURES).count() == 3
    assert not list((tmp_path / "staged_procedures").iterdir())
    assert load.ledger.last(spark, root, load.PROCEDURES)["rows"] == 3


def test_a_load_holds_the_shuffle_files_of_one_step(spark, tables, tmp_path, monkeypatch):
    """New rows, their keys and their numbers are written down in turn, and no step's shuffle files stay."""

    def files():
        folders = (spark.conf.get("spark.local.dir", "/tmp"), os.environ.get("SPARK_LOCAL_DIRS", "/tmp"))
        return {f for d in folders for f in glob.glob(f"{d}/**/blockmgr-*/*/shuffle_*.data", recursive=True)}

    read, append = [], load.writers.append_fact
    monkeypatch.setattr(load.writers, "append_fact", lambda table, rows, *rest: read.append(rows.inputFiles()) or append(table, rows, *rest))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = files()
    try:
        report = load.run_pipeline(spark, tables, str(tmp_path), "full", *WINDOW, as_of=date(2024, 6, 1), now=NOW)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert read[0] and all("/staged_procedures/" in f for f in read[0])
    end = time.time() + 20
    while left := files() - before:
        assert time.time() < end, left
        time.sleep(0.2)
    assert {r.status for r in report.collect()} == {"SUCCESS"} and load.read_table(spark, str(tmp_path), load.PROCEDURES).count() == 3


def test_compressed_documents_are_read(spark, tmp_path):
    for options in ({}, {"compression": "gzip"}):
        spark.createDataFrame([("p1", "2024-05-01T10:00:00")], "procedure_id string, timestamp string").write.mode("append").options(**options).json(str(tmp_path))
    assert [r.procedure_id for r in readers.read_telemetry(spark, str(tmp_path)).collect()] == ["p1", "p1"]
