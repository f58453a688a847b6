from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from suturestar.operators import quality
from suturestar.operators.keys import add_keys, add_sparse_keys, next_key
from suturestar.operators.lookup import Lookup, resolve_keys
from suturestar.operators.rows import greatest_per_key, one_per_key, only_new
from suturestar.operators.scd import scd2_changes, scd2_merge, version_as_of
from suturestar.operators.upsert import OPERATIONAL_LINKS, cascade_delete, upsert

DIM = "k int, id string, name string, spec string, effective_date date, expiration_date date, is_current boolean"
D0, D1, D2 = date(2024, 1, 1), date(2024, 6, 1), date(2024, 7, 1)


def dim(spark, *rows):
    return spark.createDataFrame(list(rows), DIM)


def snap(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, name string, spec string, effective_date date")


def state(df):
    return sorted((r.k, r.id, r.name, r.effective_date, r.expiration_date, r.is_current) for r in df.collect())


@pytest.fixture
def base(spark):
    return dim(
        spark,
        (1, "a", "Ann", "x", D0, None, True),
        (2, "b", "Bob", "x", D0, None, True),
        (3, "c", "Cy", None, D0, None, True),
        (4, "d", "Old", "x", date(2020, 1, 1), date(2023, 12, 31), False),
        (5, "d", "Dee", "x", D0, None, True),
    )


def test_scd2_new_changed_same_absent(spark, base):
    fresh = snap(
        spark, ("a", "Ann", "x", D0), ("b", "Ann", "x", D0), ("c", "Cy", "y", D0), ("e", "Eve", "x", date(2024, 5, 5))
    )
    out = scd2_merge(base, fresh, "id", ["name", "spec"], D1, surrogate="k")
    rows = state(out)
    assert len(rows) == 8
    by_id = {}
    for r in rows:
        by_id.setdefault(r[1], []).append(r)
    assert by_id["a"] == [(1, "a", "Ann", D0, None, True)]
    # renamed to a name another surgeon holds: still one current row per id
    assert by_id["b"][0] == (2, "b", "Bob", D0, date(2024, 5, 31), False)
    assert by_id["b"][1][2:] == ("Ann", D1, None, True)
    # NULL to a value is a change
    assert [r[5] for r in by_id["c"]] == [False, True]
    assert by_id["d"] == [(4, "d", "Old", date(2020, 1, 1), date(2023, 12, 31), False), (5, "d", "Dee", D0, None, True)]
    assert by_id["e"][0][3:] == (date(2024, 5, 5), None, True)
    assert sorted(r[0] for r in rows) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert quality.version_overlaps(out, "id").isEmpty()


def test_scd2_second_run_adds_nothing(spark, base):
    fresh = snap(spark, ("a", "Anna", "x", D0), ("z", "Zed", "x", D0))
    once = scd2_merge(base, fresh, "id", ["name", "spec"], D1, surrogate="k")
    twice = scd2_merge(once, fresh, "id", ["name", "spec"], D1, surrogate="k")
    later = scd2_merge(once, fresh, "id", ["name", "spec"], D2, surrogate="k")
    assert state(once) == state(twice) == state(later)


def test_scd2_reference_mode_and_same_day(spark, base):
    fresh = snap(spark, ("a", "Ann", "x", D0))
    once = scd2_merge(base, fresh, "id", ["name"], D1, "reference", surrogate="k")
    assert once.filter("id = 'a'").count() == 2
    again = scd2_merge(once, fresh, "id", ["name"], D1, "reference", surrogate="k")
    assert state(again) == state(once)  # replaced in place on the same day, no empty interval
    labels = {r.id: r.change for r in scd2_changes(once, fresh, "id", ["name"], D1, "reference").filter("is_current").collect()}
    assert labels["a"] == "amended" and labels["b"] == "absent"
    with pytest.raises(ValueError):
        scd2_changes(base, fresh, "id", ["name"], D1, "other")


def test_scd2_takes_latest_copy(spark):
    current = dim(spark).limit(0)
    fresh = spark.createDataFrame(
        [("a", "Old name", "x", D0, 1), ("a", "New name", "x", D0, 2)],
        "id string, name string, spec string, effective_date date, seen int",
    )
    rows = state(scd2_merge(current, fresh, "id", ["name"], D1, surrogate="k", order=("seen",)))
    assert rows == [(1, "a", "New name", D0, None, True)]


def test_version_as_of(spark, base):
    fact = spark.createDataFrame(
        [("d", date(2023, 12, 31)), ("d", D0), ("d", date(2019, 1, 1)), ("q", D0)], "id string, day date"
    )
    got = sorted(tuple(r) for r in version_as_of(fact, base, "id", "day", ["name"]).collect())
    assert got == [("d", date(2023, 12, 31), "Old"), ("d", D0, "Dee")]
    assert version_as_of(fact, base, "id", "day", ["name"], "left").count() == 4


def test_keys(spark):
    df = spark.range(1000).withColumnRenamed("id", "x")
    keyed = add_keys(df, "k", ["x"], start=7, buckets=16)
    assert sorted(r.k for r in keyed.collect()) == list(range(8, 1008))
    assert sorted(map(tuple, keyed.repartition(3).collect())) == sorted(map(tuple, keyed.collect()))
    sparse = sorted(r.k for r in add_sparse_keys(df, "k", ["x"], start=7, buckets=16).collect())
    assert len(set(sparse)) == 1000 and sparse[0] > 7 and sparse[-1] < 7 + 2 * 1000
    more = add_keys(spark.range(3).toDF("x"), "k", ["x"], start=next_key(keyed, "k"), buckets=4)
    assert sorted(r.k for r in more.collect()) == [1008, 1009, 1010]
    assert sorted(r.k for r in add_keys(df.limit(2), "k", ["x"], next_key(keyed.limit(0), "k")).collect()) == [1, 2]


def test_one_per_key_and_only_new(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "w"), ("b", 1, None), (None, 1, "n")], "k string, t int, v string")
    assert sorted(map(str, one_per_key(df, ["k"], ["t"]).collect())) == sorted(
        map(str, df.filter("k is null or k = 'b' or t = 2").collect())
    )
    target = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {r.k for r in only_new(df, target, ["k"]).collect()} == {"b", None}


def test_upsert(spark):
    target = spark.createDataFrame(
        [("p1", "type1", "in_progress", None, None), ("p2", "type2", "completed", 5, None)],
        "id string, kind string, status string, minutes int, updated_at timestamp_ntz",
    )
    updates = spark.createDataFrame(
        [("p1", "other", "completed", 30, 1), ("p1", "other", "aborted", None, 2), ("p3", "first", "in_progress", 1, 1),
         ("p3", "second", "completed", 9, 2)],
        "id string, kind string, status string, minutes int, seq int",
    )
    now = datetime(2024, 1, 1)
    out = upsert(target, updates, "id", ["status", "minutes"], "seq", stamp=("updated_at", now))
    assert sorted(map(tuple, out.collect())) == [
        ("p1", "type1", "aborted", None, now),  # other columns left alone, the last of two updates, NULL written
        ("p2", "type2", "completed", 5, None),
        ("p3", "first", "completed", 9, now),
    ]
    twice = upsert(out, updates, "id", ["status", "minutes"], "seq", stamp=("updated_at", now))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, out.collect()))


def test_cascade_delete(spark):
    tables = {
        "surgical_robots": spark.createDataFrame([("r1",), ("r2",)], "robot_id string"),
        "surgical_procedures": spark.createDataFrame([("p1", "r1"), ("p2", "r2")], "procedure_id string, robot_id string"),
        "procedure_outcomes": spark.createDataFrame([("o1", "p1"), ("o2", "p2")], "outcome_id string, procedure_id string"),
        "robot_maintenance_logs": spark.createDataFrame([("m1", "r1"), ("m2", "r2")], "maintenance_id string, robot_id string"),
    }
    out = cascade_delete(tables, "surgical_robots", "robot_id", tables["surgical_robots"].filter("robot_id = 'r1'"), OPERATIONAL_LINKS)
    assert [out[t].count() for t in tables] == [1, 1, 1, 1]
    assert out["procedure_outcomes"].first().outcome_id == "o2"


def test_resolve_keys(spark, base):
    stage = spark.createDataFrame([("f1", "a"), ("f2", "nobody"), ("f3", None)], "f string, id string")
    rows, rejects = resolve_keys(stage, {"surgeon": Lookup(base, "id", "k")})
    assert {r.f: r.k for r in rows.collect()} == {"f1": 1, "f2": -1, "f3": -1}
    assert {r.f: r.unknown_members for r in rejects.collect()} == {"f2": ["surgeon"], "f3": ["surgeon"]}


def test_checks_pass_on_null(spark):
    df = spark.createDataFrame(
        [("p1", 120, 5.0, "completed", "2024-01-01 10:00:00", "2024-01-01 10:00:00"),
         ("p2", 121, 0.9, "done", "2024-01-01 10:00:00", "2024-01-01 09:59:59"),
         ("p3", None, None, None, None, None)],
        "procedure_id string, patient_age int, complexity_score double, status string, start_time string, end_time string",
    )
    got = quality.validate(df, quality.check_rules("surgical_procedures"), ["procedure_id"]).collect()
    assert {tuple(r) for r in got} == {
        ("p2", "patient_age"), ("p2", "complexity_score"), ("p2", "status"), ("p2", "end_after_start"),
    }
    nulls = quality.validate(df, quality.not_null_rules(["status"]), ["procedure_id"]).collect()
    assert [tuple(r) for r in nulls] == [("p3", "status is null")]
    long = quality.validate(df, quality.length_rules({"status": 5}), ["procedure_id"]).collect()
    assert {r.procedure_id for r in long} == {"p1"}


def test_unique_foreign_and_required(spark):
    df = spark.createDataFrame([("a", "r1"), ("a", "r9"), ("b", None), (None, "r1"), (None, "r1")], "id string, robot_id string")
    assert [tuple(r) for r in quality.unique_violations(df, ["id"]).collect()] == [("a", 2)]
    robots = spark.createDataFrame([("r1",)], "robot_id string")
    assert [r.robot_id for r in quality.foreign_key_violations(df, robots, "robot_id").collect()] == ["r9"]
    docs = spark.createDataFrame([("p", "t", "r"), ("p", None, None)], "procedure_id string, timestamp string, robot_id string")
    accepted, rejected = quality.split_required(docs)
    assert accepted.count() == 1
    assert rejected.first().reason == "Missing required field: timestamp"


def test_overlaps_are_found(spark):
    bad = dim(
        spark,
        (1, "a", "A", "x", D0, D1, False),
        (2, "a", "A", "x", D1, None, True),
        (3, "b", "B", "x", D0, None, True),
        (4, "b", "B", "x", D0, None, True),
        (5, "c", "C", "x", D0, None, True),
    )
    assert {r.id for r in quality.version_overlaps(bad, "id").collect()} == {"a", "b"}


def test_versions_are_not_broadcast_month_by_month(spark, base):
    """Spark's estimate of the versions' months is that of the versions, so it would send them whole to every task."""
    fact = spark.createDataFrame([("d", D0), ("q", D0)], "id string, day date")
    out = version_as_of(fact, base, "id", "day", ["name"], span=(date(2019, 1, 1), date(2024, 12, 31)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert [tuple(r) for r in out.collect()] == [("d", D0, "Dee")]


def test_greatest_per_key_is_one_per_key(spark):
    ddl = "id string, a int, b string, c decimal(3,1), d double"
    rows = [("x", 1, "p", None, 1.0), ("x", 1, None, None, 2.0), ("x", None, "z", None, float("nan")), (None, 2, "q", None, None),
            (None, 2, "q", None, 0.5), ("y", None, None, None, None), ("y", None, None, None, None)]
    df = spark.createDataFrame(rows, ddl)
    got, want = greatest_per_key(df, ["id"]), one_per_key(df, ["id"])
    assert got.schema.names == want.schema.names and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert greatest_per_key(df.select("id"), ["id"]).count() == 3
