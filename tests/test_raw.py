"""VARIANT landing of raw telemetry, and the version join by months."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from suturestar.operators.scd import version_as_of, version_months
from suturestar.plans.telemetry import flatten_telemetry
from suturestar.sources import raw
from suturestar.sources.readers import read_telemetry
from suturestar.streaming.jobs import stream_raw

GOOD = {"procedure_id": "P1", "timestamp": "2024-03-01T10:00:00Z", "system_metrics": {"temperature": 36.5, "fan": 7}, "arm_rotation": {"x": 1.25}}
LINES = [
    json.dumps(GOOD),
    json.dumps([{"procedure_id": "P2", "timestamp": "2024-03-02T10:00:00", "video_fps": "60", "lens": {"id": "L-9"}}, 5]),
    '{"procedure_id": "P3", "timestamp": "soon"}',
    '{"procedure_id": "P4", "procedure_id": "P5"}',
    '{"procedure_id": "P6", "timest',
    "",
    "   ",
    "[]",
    "null",
    '"text"',
]


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES))
    stream_raw(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    return str(tmp_path / "out")


def test_raw_keeps_undeclared_fields(spark, landed):
    rows = raw.read_raw(spark, landed).select(
        raw.field("$.procedure_id", "string"), "sample_date", raw.field("$.system_metrics.fan", "int"), raw.field("$.lens.id", "string")
    )
    assert sorted(map(tuple, rows.collect())) == [
        ("P1", date(2024, 3, 1), 7, None),
        ("P2", date(2024, 3, 2), None, "L-9"),
        ("P3", None, None, None),
    ]


def test_raw_keeps_what_is_no_record(spark, landed):
    rows = spark.read.schema("reason string, document string").json(f"{landed}/rejected").collect()
    assert {r.reason for r in rows} == {"malformed document"}
    assert sorted(r.document for r in rows) == sorted([LINES[3], LINES[4], "5", "null", "text"])


def test_raw_replay_and_days(spark, landed):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    raw.land_raw(lines, landed, 0)
    records = raw.read_raw(spark, landed)
    assert records.count() == 3
    one = records.filter(F.col("sample_date") == date(2024, 3, 2))
    assert len(one.inputFiles()) >= 1 and one.count() == 1
    assert "PartitionFilters: [isnotnull(sample_date" in one._jdf.queryExecution().toString()


def test_raw_of_no_lines(spark, tmp_path):
    records, refused = raw.parsed(spark.createDataFrame([(None,), ("",)], "value string"))
    assert records.count() == 0 and refused.count() == 0


def test_typed_columns_equal_a_plain_read(spark, landed, tmp_path):
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.json").write_text("\n".join(LINES[:3]).replace(", 5]", "]"))
    plain = flatten_telemetry(read_telemetry(spark, str(tmp_path / "plain")))[0]
    cut = flatten_telemetry(raw.documents(raw.read_raw(spark, landed)))[0]
    assert cut.schema == plain.schema
    rows = sorted(map(tuple, cut.collect()), key=str)
    assert rows == sorted(map(tuple, plain.collect()), key=str) and len(rows) == 2


DIM = "id string, effective_date date, expiration_date date, name string"


def history(spark, n):
    """One key with a version for each of `n` quarters, the last one open, and another with sentinel dates."""
    first = date(2015, 1, 1)
    starts = [first + timedelta(days=91 * i) for i in range(n)]
    ends = [s - timedelta(days=1) for s in starts[1:]] + [None]
    rows = [("hot", s, e, f"v{i}") for i, (s, e) in enumerate(zip(starts, ends))]
    return spark.createDataFrame([*rows, ("other", date(1900, 1, 1), date(9999, 12, 31), "o"), ("none", None, None, "n")], DIM)


def test_versions_by_month_meet_few_rows(spark):
    dim = history(spark, 40)
    days = [("hot", date(2015, 1, 1) + timedelta(days=i)) for i in range(3640)]
    fact = spark.createDataFrame([*days, ("other", date(2016, 2, 29)), ("none", date(2016, 1, 1)), ("hot", None)], "id string, day date")
    out = version_as_of(fact, dim, "id", "day", ["name"])
    got = {(r.id, r.day): r.name for r in out.collect()}
    assert len(got) == 3641 == out.count() and got["other", date(2016, 2, 29)] == "o"
    assert all(got["hot", d] == f"v{min(i // 91, 39)}" for i, (_, d) in enumerate(days))
    assert version_as_of(fact, dim, "id", "day", ["name"], "left").count() == fact.count()

    span = F.lit(date(2015, 1, 1)), F.lit(days[-1][1])
    months = version_months(dim, "id", ["name"], *span)
    met = fact.withColumn("month__", F.trunc("day", "month")).join(months, ["id", "month__"]).count()
    assert met <= 2 * out.count()
    assert months.filter("id = 'other'").count() == 120


def test_version_join_is_on_key_and_month(spark):
    fact = spark.createDataFrame([("hot", date(2016, 1, 1))], "id string, day date")
    out = version_as_of(fact, history(spark, 4), "id", "day", ["name"], span=(date(2015, 1, 1), date(2017, 1, 1)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "trunc(" in plan and "month__" in plan and out.first().name == "v3"
    empty = version_as_of(fact.filter("false"), history(spark, 4), "id", "day", ["name"])
    assert empty.count() == 0 and empty.columns == ["id", "day", "name"]
