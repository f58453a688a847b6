import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from suturestar.plans import load
from suturestar.plans.telemetry import flatten_telemetry, load_telemetry
from suturestar.schemas import TELEMETRY_STAGE, conform
from suturestar.sources import readers, writers
from suturestar.streaming import jobs

NESTED = {
    "procedure_id": "p1",
    "robot_id": "r1",
    "timestamp": "2024-01-15T10:30:00Z",
    "arm_position": {"x": 1.25, "y": -2, "z": 3.00005},
    "arm_rotation": {"x": 0.5, "y": 0, "z": 1},
    "force_feedback": 2.5,
    "tool_type": "scalpel",
    "tool_active": True,
    "camera_zoom": 1.5,
    "lighting_level": 80,
    "system_metrics": {"temperature": 36.6, "motor_current": 1.2345, "network_latency_ms": 12, "video_fps": 60},
}
FLAT = {
    "telemetry_id": "t1",
    "procedure_id": "p1",
    "timestamp": "2024-01-15 10:31:00.123",
    "arm_position_x": "7.5",
    "arm_rotation": "12.34",
    "tool_type": "camera",
    "system_temperature": 25.5,
}


def at(minute, **changes):
    return {**NESTED, "timestamp": f"2024-01-15T10:{minute:02d}:00Z", **changes}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "telemetry" / "p1").mkdir(parents=True)
    (tmp_path / "batch" / "telemetry").mkdir(parents=True)
    (tmp_path / "telemetry" / "p1" / "one.json").write_text(json.dumps(NESTED))
    (tmp_path / "telemetry" / "p1" / "ignored.txt").write_text(json.dumps(at(59)))
    (tmp_path / "batch" / "telemetry" / "array.json").write_text(
        json.dumps([at(32), at(33, timestamp="2024-01-15T10:33:00+05:00", tool_active=0)])
    )
    lines = [
        FLAT,
        at(34, tool_active=None, lighting_level="bright"),
        at(35, timestamp=None),
        at(36, timestamp="soon"),
        at(37, arm_position="nowhere"),
        at(38, arm_position=None, system_metrics=None),
        at(39, procedure_id="orphan"),
    ]
    lines[2].pop("timestamp")
    (tmp_path / "telemetry" / "many.json").write_text("\n".join(json.dumps(x) for x in lines))
    (tmp_path / "telemetry" / "broken.json").write_text('{"procedure_id": "p1", "timestamp": \n')
    return tmp_path


def read(spark, folder):
    return readers.read_telemetry(spark, str(folder / "telemetry"), str(folder / "batch"))


def test_three_shapes_two_layouts(spark, folder):
    samples, refused = flatten_telemetry(read(spark, folder))
    assert samples.columns == list(TELEMETRY_STAGE)
    rows = {r.sample_timestamp.minute: r for r in samples.collect()}
    assert sorted(rows) == [30, 31, 32, 33, 34, 38, 39]
    n = rows[30]
    assert (n.arm_position_x, n.arm_position_y, n.arm_position_z) == (
        Decimal("1.2500"), Decimal("-2.0000"), Decimal("3.0001"),
    )
    assert (n.arm_rotation_x, n.system_temperature, n.motor_current) == (
        Decimal("0.5000"), Decimal("36.60"), Decimal("1.2345"),
    )
    assert (n.timestamp_key, n.tool_active, n.lighting_level, n.network_latency_ms, n.video_fps) == (103000, True, 80, 12, 60)
    f = rows[31]
    assert (f.arm_position_x, f.system_temperature, f.arm_rotation_x, f.video_fps) == (
        Decimal("7.5000"), Decimal("25.50"), None, None,
    )
    assert f.sample_timestamp == datetime(2024, 1, 15, 10, 31, 0, 123000)
    assert (rows[33].timestamp_key, rows[33].tool_active) == (103300, False)  # the clock as written
    assert (rows[34].tool_active, rows[34].lighting_level) == (False, None)
    assert rows[38].arm_position_x is None and rows[38].system_temperature is None
    reasons = sorted(r.reason for r in refused.collect())
    assert reasons == ["malformed document", "malformed document", "missing timestamp", "unreadable timestamp"]
    assert any("nowhere" in r.document for r in refused.collect())


def test_pretty_printed_files(spark, tmp_path):
    (tmp_path / "doc.json").write_text(json.dumps([at(1), at(2)], indent=2))
    raw = readers.read_telemetry(spark, str(tmp_path), multi_line=True)
    assert flatten_telemetry(raw)[0].count() == 2


def test_load_drops_copies_orphans_and_known(spark, folder):
    samples, _ = flatten_telemetry(read(spark, folder))
    twice = samples.unionByName(samples)
    procedures = spark.createDataFrame([("p1", 11)], "procedure_id string, procedure_key bigint")
    held = spark.createDataFrame([(11, datetime(2024, 1, 15, 10, 30))], "procedure_key bigint, sample_timestamp timestamp_ntz")
    rows, orphans = load_telemetry(twice, procedures, held)
    assert sorted(r.sample_timestamp.minute for r in rows.collect()) == [31, 32, 33, 34, 38]
    assert {r.procedure_id for r in orphans.collect()} == {"orphan"}


def fact(spark, root, *ids):
    rows = spark.createDataFrame([(i + 1, p) for i, p in enumerate(ids)], "procedure_key bigint, procedure_id string")
    full = rows.withColumns(
        {c: F.lit(0) for c in ("robot_key", "surgeon_key", "facility_key", "start_time_key")}
    ).withColumns({"start_date_key": F.lit(20240115), "procedure_type": F.lit("t"), "procedure_category": F.lit("c")})
    writers.append_procedures(conform(full, "fact_procedures", datetime(2024, 1, 1)), f"{root}/fact_procedures")


def test_stream_equals_batch_and_is_idempotent(spark, folder):
    root, checkpoint = str(folder / "star"), str(folder / "checkpoint")
    fact(spark, root, "p1")
    source = str(folder / "telemetry")
    for _ in range(2):
        jobs.stream_telemetry(spark, source, root, checkpoint, max_files=1).awaitTermination()
    rows = load.read_table(spark, root, "fact_procedure_telemetry")
    assert sorted(r.sample_timestamp.minute for r in rows.collect()) == [30, 31, 34, 38]
    # a new file that repeats a sample, and a lost checkpoint that replays everything
    (folder / "telemetry" / "more.json").write_text("\n".join(json.dumps(x) for x in (at(30), at(50))))
    jobs.stream_telemetry(spark, source, root, checkpoint).awaitTermination()
    jobs.stream_telemetry(spark, source, root, checkpoint + "2").awaitTermination()
    stream = load.read_table(spark, root, "fact_procedure_telemetry")
    assert sorted(r.sample_timestamp.minute for r in stream.collect()) == [30, 31, 34, 38, 50]
    assert stream.select("telemetry_key").distinct().count() == 5

    other = str(folder / "batch_star")
    fact(spark, other, "p1")
    load.load_samples(spark, readers.read_telemetry(spark, source), other)
    batch = load.read_table(spark, other, "fact_procedure_telemetry")
    same = ["procedure_key", "sample_timestamp", "tool_type", "system_temperature"]
    assert sorted(map(str, batch.select(*same).collect())) == sorted(map(str, stream.select(*same).collect()))


def test_stream_with_state_and_refused(spark, folder):
    root = str(folder / "star")
    fact(spark, root, "p1")
    source = str(folder / "telemetry")
    jobs.stream_telemetry(spark, source, root, str(folder / "c1"), delay="1 day").awaitTermination()
    jobs.stream_refused(spark, source, root, str(folder / "c2")).awaitTermination()
    assert load.read_table(spark, root, "fact_procedure_telemetry").count() == 4
    assert spark.read.json(f"{root}/rejected_telemetry").count() == 4


def test_ingest_split(spark, folder):
    landed = str(folder / "landed")
    jobs.stream_ingest(spark, str(folder / "telemetry"), landed, str(folder / "c")).awaitTermination()
    accepted = spark.read.json(f"{landed}/telemetry")
    rejected = spark.read.json(f"{landed}/rejected")
    assert accepted.count() == 5  # 'soon' is present, so it is accepted here and refused by the load
    assert {r.reason for r in rejected.collect()} == {
        "Missing required field: timestamp", "Missing required field: robot_id", "malformed document",
    }


def test_procedure_changes(spark, tmp_path):
    source, log = tmp_path / "in", str(tmp_path / "log")
    source.mkdir()

    def put(name, *records):
        (source / name).write_text("\n".join(json.dumps(r) for r in records))

    put("a.json", {"procedure_id": "p1", "procedure_type": "A", "status": "in_progress", "recorded_at": "2024-01-01 10:00:00"})
    run = lambda: jobs.stream_procedures(spark, str(source), log, str(tmp_path / "c")).awaitTermination()
    run()
    put("b.json", {"procedure_id": "p1", "procedure_type": "B", "status": "completed", "duration_minutes": 7,
                   "recorded_at": "2024-01-01 11:00:00"},
        {"procedure_id": "p2", "procedure_type": "C", "status": "aborted", "recorded_at": "2024-01-01 09:00:00"})
    run()
    run()
    now = jobs.current_procedures(spark, log)
    got = {r.procedure_id: (r.procedure_type, r.status, r.duration_minutes) for r in now.collect()}
    assert got == {"p1": ("A", "completed", 7), "p2": ("C", "aborted", None)}
    again = jobs.current_procedures(spark, log, base=now)
    assert {r.procedure_id: (r.procedure_type, r.status, r.duration_minutes) for r in again.collect()} == got


def test_stage_csv_round_trip_and_empty(spark, folder, tmp_path):
    samples, _ = flatten_telemetry(read(spark, folder))
    assert writers.write_telemetry_stage(samples.filter("false"), str(tmp_path / "s"), "20240115") is None
    path = writers.write_telemetry_stage(samples, str(tmp_path / "s"), "20240115")
    assert path.endswith("etl-staging/20240115/telemetry")
    from suturestar.schemas import TELEMETRY_STAGE_DDL

    back = readers.read_staged_csv(spark, path, TELEMETRY_STAGE_DDL)
    assert sorted(map(str, back.collect())) == sorted(map(str, samples.collect()))


def test_days_are_pruned(spark, tmp_path):
    root = str(tmp_path)
    fact(spark, root, "p1")
    docs = spark.createDataFrame([(json.dumps(at(1, timestamp=f"2024-01-{d:02d}T10:00:00")),) for d in (1, 2, 3)], "v string")
    docs.write.text(f"{root}/raw")
    schema = readers.TELEMETRY_DOCUMENT_DDL
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(f"{root}/raw")
    load.load_samples(spark, raw, root)
    existing = load.read_table(spark, root, "fact_procedure_telemetry")
    stage = flatten_telemetry(raw)[0].filter(F.to_date("sample_timestamp") == F.lit(date(2024, 1, 2)))
    from suturestar.plans.telemetry import prune_to_days

    pruned = prune_to_days(existing, stage)
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(sample_date" in plan and "2024-01-02" in plan
    # The load itself reads no other day to find what is there.
    from suturestar.plans.telemetry import load_telemetry as joined

    rows, _ = joined(stage, load.read_table(spark, root, "fact_procedures"), existing)
    assert "PartitionFilters: [isnotnull(sample_date" in rows._jdf.queryExecution().toString()


def test_late_procedure_and_empty_first_batch(spark, folder):
    """Telemetry comes before its procedure: nothing is lost, and an append without rows blocks nothing."""
    root, source = str(folder / "star"), str(folder / "telemetry")
    run = lambda: jobs.stream_telemetry(spark, source, root, str(folder / "c"), max_files=1).awaitTermination()
    run()
    assert load.read_table(spark, root, "fact_procedure_telemetry").count() == 0
    waiting = load.waiting_samples(spark, root)
    assert waiting.filter("procedure_id = 'p1'").count() > 0
    fact(spark, root, "p1")
    assert load.retry_orphans(spark, root)[2] > 0
    late = load.read_table(spark, root, "fact_procedure_telemetry")
    assert load.waiting_samples(spark, root).filter("procedure_id = 'p1'").count() == 0
    assert load.retry_orphans(spark, root)[2] == 0

    other = str(folder / "batch_star")
    fact(spark, other, "p1")
    load.load_samples(spark, readers.read_telemetry(spark, source), other)
    batch = load.read_table(spark, other, "fact_procedure_telemetry")
    same = ["procedure_key", "sample_timestamp", "system_temperature"]
    assert sorted(map(str, batch.select(*same).collect())) == sorted(map(str, late.select(*same).collect()))


def test_waiting_samples_join_a_later_batch(spark, folder):
    root, source = str(folder / "star"), folder / "telemetry"
    jobs.stream_telemetry(spark, str(source), root, str(folder / "c")).awaitTermination()
    fact(spark, root, "p1")
    (source / "later.json").write_text(json.dumps(at(55)))
    jobs.stream_telemetry(spark, str(source), root, str(folder / "c")).awaitTermination()
    rows = load.read_table(spark, root, "fact_procedure_telemetry")
    assert sorted(r.sample_timestamp.minute for r in rows.collect()) == [30, 31, 34, 38, 55]


def test_ingest_keeps_every_record_as_it_came(spark, tmp_path):
    good = '{"procedure_id": "p1", "robot_id": "r1", "timestamp": "2024-01-15T10:00:00Z", "session": {"n": 2.5}, "lighting_level": 7}'
    lines = [good, '{"procedure_id": "p1", broken', '{"procedure_id": "p1", "robot_id": "r1", "timestamp": "2024-01-15T10:00:00Z", "arm_position": "nowhere"}', '{"procedure_id": "p2"}', "", f"[{good}, {good}]"]
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text("\n".join(lines))
    landed = str(tmp_path / "landed")
    jobs.stream_ingest(spark, str(source), landed, str(tmp_path / "c")).awaitTermination()
    accepted = spark.read.json(f"{landed}/telemetry")
    assert [(r.session.n, r.lighting_level, str(r.sample_date)) for r in accepted.collect()] == [(2.5, 7, "2024-01-15")] * 3
    assert good in [r.value for r in spark.read.option("recursiveFileLookup", True).text(f"{landed}/telemetry").collect()]
    rejected = {r.document: r.reason for r in spark.read.json(f"{landed}/rejected").collect()}
    assert rejected == {lines[1]: "malformed document", lines[2]: "malformed document", lines[3]: "Missing required field: timestamp"}


def test_procedure_changes_in_order_of_arrival(spark, tmp_path):
    source, log = tmp_path / "in", str(tmp_path / "log")
    source.mkdir()
    steps = [{"status": "in_progress", "duration_minutes": 5}, {"status": "completed", "duration_minutes": 90, "end_time": "2024-01-01 12:00:00"}, {"status": "aborted", "duration_minutes": 1}]
    for n, step in enumerate(steps):
        (source / f"{n}.json").write_text(json.dumps({"procedure_id": "p1", "procedure_type": f"T{n}", **step}))
        jobs.stream_procedures(spark, str(source), log, str(tmp_path / "c")).awaitTermination()
        now = jobs.current_procedures(spark, log).first()
        assert (now.procedure_type, now.status, now.duration_minutes) == ("T0", step["status"], step["duration_minutes"])
        assert (now.end_time is not None) == ("end_time" in step)
