"""Bucketed facts, the ledger of writes, and the store of waiting samples."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from suturestar.plans import load, reports, views
from suturestar.plans.star import Star
from suturestar.plans.telemetry import flatten_telemetry
from suturestar.schemas import conform
from suturestar.sources import ledger, readers, snapshots, waiting, writers

NOW = datetime(2024, 2, 1)


def procedures(spark, root, start, *ids, buckets=4):
    """Append procedures through the ledger, as a load does."""
    rows = [(start + n, i, 1, 1, 20240115, 100000, "completed") for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "procedure_key long, procedure_id string, robot_key int, facility_key int, start_date_key int, start_time_key int, status string")
    with ledger.writing(spark, root, load.PROCEDURES) as held:
        held.values = {"buckets": buckets, "key": start + len(ids) - 1}
        writers.append_fact(load.PROCEDURES, conform(df, load.PROCEDURES, NOW), f"{root}/{load.PROCEDURES}", buckets=buckets)


def samples(spark, tmp_path, *rows):
    """(procedure, day, minute) as telemetry."""
    docs = [json.dumps({"procedure_id": p, "timestamp": f"{day}T10:{m:02d}:00", "robot_id": "r", "system_metrics": {"temperature": 70.5 + m}}) for p, day, m in rows]
    path = tmp_path / f"raw-{len(list(tmp_path.iterdir()))}"
    path.mkdir()
    (path / "a.json").write_text("\n".join(docs))
    raw = spark.read.schema(readers.TELEMETRY_DOCUMENT_DDL).option("columnNameOfCorruptRecord", "_corrupt").json(str(path))
    return flatten_telemetry(raw)[0]


def held(spark, root):
    fact = load.read_table(spark, root, load.TELEMETRY)
    return sorted((r.procedure_key, str(r.sample_date), r.sample_timestamp.minute) for r in fact.collect())


def files(root, folder):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{root}/{folder}") for f in names if f.endswith(".parquet")}


@pytest.fixture
def star_root(spark, tmp_path):
    root = str(tmp_path / "star")
    procedures(spark, root, 1, *[f"p{i}" for i in range(40)])
    rows = [(f"p{i}", f"2024-01-{1 + i % 3:02d}", m) for i in range(40) for m in range(3)]
    load.append_samples(spark, samples(spark, tmp_path, *rows), root, NOW, buckets=4)
    return root


@pytest.fixture
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def _below_telemetry(plan):
    """Whether an Exchange lies between the telemetry scan and its join with the procedures."""
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "system_temperature" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*("))
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-*("))
        if at < depth:
            depth = at
            if "Exchange" in line:
                return True
            if "Join" in line:
                return False
    return None


@pytest.mark.parametrize("report", [views.vw_telemetry_system_health, lambda s: reports.q11_robot_health(s, at_least=1)])
def test_telemetry_meets_its_procedures_without_a_shuffle(spark, star_root, no_broadcast, report):
    dims = {
        "dim_robots": "robot_key int, robot_id string, robot_model string, is_current boolean",
        "dim_facilities": "facility_key int, facility_name string, is_current boolean",
    }
    rows = {"dim_robots": [(1, "r1", "M1", True)], "dim_facilities": [(1, "North", True)]}
    loaded = load.load_star(spark, star_root)
    facts = {t: getattr(loaded, t) for t in (load.PROCEDURES, load.TELEMETRY, "dim_date")}
    star = Star(**facts, **{t: spark.createDataFrame(rows[t], ddl) for t, ddl in dims.items()})
    executed = report(star)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Bucketed: true") == 2 and _below_telemetry(executed) is False


def test_bucketed_facts_hold_what_was_loaded(spark, star_root, tmp_path):
    assert len(held(spark, star_root)) == 120
    per_key = load.read_table(spark, star_root, load.TELEMETRY).groupBy("procedure_key").count()
    assert {r["count"] for r in per_key.collect()} == {3} and per_key.count() == 40
    # Plain files of the same folder say the same, and every file has rows of one bucket only.
    plain = spark.read.parquet(f"{star_root}/{load.TELEMETRY}").withColumn("file", F.input_file_name())
    spread = plain.groupBy("file").agg(F.count_distinct(F.pmod(F.hash("procedure_key"), F.lit(4))).alias("n"))
    assert {r.n for r in spread.collect()} == {1}
    assert sum(ledger.last(spark, star_root, load.TELEMETRY)["loads"]) == 120


def test_a_fact_with_one_heavy_key_is_read_as_plain_files(spark, star_root, monkeypatch):
    assert load._lopsided([2_000_000, 10, 10, 10, 10]) and not load._lopsided([300_000] * 5) and not load._lopsided(None)
    monkeypatch.setattr(load, "_lopsided", lambda loads: True)
    plan = load.read_table(spark, star_root, load.TELEMETRY).groupBy("procedure_key").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" not in plan and len(held(spark, star_root)) == 120


def test_files_from_before_the_ledger_stay_plain(spark, tmp_path):
    root = str(tmp_path / "star")
    df = spark.createDataFrame([(7, "p1", 20240115)], "procedure_key long, procedure_id string, start_date_key int")
    writers.append_procedures(conform(df, load.PROCEDURES, NOW), f"{root}/{load.PROCEDURES}")
    with ledger.writing(spark, root, load.PROCEDURES) as claim:
        existing = load.read_table(spark, root, load.PROCEDURES)
        assert load._buckets(spark, claim, f"{root}/{load.PROCEDURES}", 16) == 0
        first = load._first_key(claim, existing, "procedure_key")
        assert spark.range(1).select(first).first()[0] == 7


# ------------------------------------------------------------------ the ledger


def test_of_two_writers_one_is_refused(spark, tmp_path):
    root = str(tmp_path)
    first = ledger.claim(spark, root, "t")
    with pytest.raises(ledger.Busy):
        ledger.claim(spark, root, "t")
    first.values["key"] = 5
    ledger.commit(spark, root, first)
    second = ledger.claim(spark, root, "t", patience=5)
    assert (second.number, second.before, second.trusted) == (2, {"key": 5}, True)
    with pytest.raises(ledger.Busy):
        ledger.commit(spark, root, first)
    assert ledger.last(spark, root, "t") == {"key": 5}


def test_a_failed_write_commits_nothing_and_frees_the_table(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(RuntimeError), ledger.writing(spark, root, "t") as held_:
        held_.values["key"] = 9
        raise RuntimeError("lost")
    assert ledger.last(spark, root, "t") == {}
    again = ledger.claim(spark, root, "t")
    assert (again.number, again.trusted) == (2, False)
    # A writer that died leaves its claim, which others pass when it is old.
    with pytest.raises(ledger.Busy):
        ledger.claim(spark, root, "t")
    assert ledger.claim(spark, root, "t", stale=0.0).trusted is False


def test_a_load_is_refused_while_another_numbers_the_same_fact(spark, star_root, tmp_path):
    open_ = ledger.claim(spark, star_root, load.TELEMETRY)
    more = samples(spark, tmp_path, ("p1", "2024-01-09", 1))
    with pytest.raises(ledger.Busy):
        load.append_samples(spark, more, star_root, NOW)
    assert len(held(spark, star_root)) == 120
    ledger.commit(spark, star_root, open_)
    assert load.append_samples(spark, more, star_root, NOW) == (1, 0)
    keys = [r[0] for r in load.read_table(spark, star_root, load.TELEMETRY).select("telemetry_key").collect()]
    assert len(keys) == len(set(keys)) == 121


def test_keys_go_on_from_the_ledger_without_a_scan(spark, star_root):
    claim = ledger.claim(spark, star_root, load.TELEMETRY)
    existing = load.read_table(spark, star_root, load.TELEMETRY)
    first = load._first_key(claim, existing, "telemetry_key")
    assert isinstance(first, int) and first >= existing.agg(F.max("telemetry_key")).first()[0]


def test_snapshots_show_only_when_committed(spark, tmp_path):
    root = str(tmp_path)
    snapshots.write_snapshot(spark.range(3), root, "dim_robots")
    with pytest.raises(RuntimeError), ledger.writing(spark, root, "dim_robots") as claim:
        snapshots.save(spark.range(9), root, claim)
        raise RuntimeError("driver lost")
    assert snapshots.read_snapshot(spark, root, "dim_robots").count() == 3
    # The success marker of the file committer plays no part.
    for d, _, names in os.walk(root):
        for f in names:
            if "_SUCCESS" in f:
                os.remove(os.path.join(d, f))
    assert snapshots.read_snapshot(spark, root, "dim_robots").count() == 3


# ------------------------------------------------------------------ waiting samples


def test_an_old_orphan_is_never_rewritten(spark, star_root, tmp_path):
    load.append_samples(spark, samples(spark, tmp_path, ("nobody", "2014-01-01", 5)), star_root, NOW)
    stored = files(star_root, waiting.STORE)
    assert load.append_samples(spark, samples(spark, tmp_path, ("p1", "2024-01-02", 40)), star_root, NOW) == (1, 0)
    assert load.waiting_samples(spark, star_root).count() == 1
    procedures(spark, star_root, 100, "q1")
    assert load.retry_orphans(spark, star_root, NOW)[2] == 0
    assert files(star_root, waiting.STORE) == stored


def test_only_days_of_found_samples_are_read(spark, star_root, tmp_path):
    from suturestar.plans.telemetry import load_telemetry

    stage = samples(spark, tmp_path, ("nobody", "2014-01-01", 5), ("p1", "2024-01-02", 41))
    rows, _ = load_telemetry(stage, load.read_table(spark, star_root, load.PROCEDURES), load.read_table(spark, star_root, load.TELEMETRY))
    plan = rows._jdf.queryExecution().toString()
    assert "sample_date" in plan and "2024-01-02" in plan and "2014-01-01" not in plan.split("PartitionFilters")[1]


def test_a_retry_reads_the_buckets_of_new_procedures_only(spark, star_root, tmp_path):
    late = [(f"q{i}", "2024-01-05", 1) for i in range(200)]
    assert load.append_samples(spark, samples(spark, tmp_path, *late), star_root, NOW) == (0, 200)
    new = spark.createDataFrame([("q7",)], "procedure_id string")
    plan = waiting.answered(spark, star_root, new)._jdf.queryExecution().toString()
    assert "bucket" in plan.split("PartitionFilters")[1][:200]
    procedures(spark, star_root, 200, "q7", "q8")
    assert load.retry_orphans(spark, star_root, NOW)[2] == 2
    assert load.waiting_samples(spark, star_root).count() == 198
    assert load.retry_orphans(spark, star_root, NOW)[2] == 0
    # A replay of the whole batch adds nothing that is held and loses nothing that waits.
    load.append_samples(spark, samples(spark, tmp_path, *late), star_root, NOW)
    assert [k for k, _, _ in held(spark, star_root) if k >= 200] == [200, 201]
    procedures(spark, star_root, 300, "q9")
    assert load.retry_orphans(spark, star_root, NOW)[2] == 1


def test_samples_that_wait_too_long_are_given_up_and_counted(spark, star_root, tmp_path):
    load.append_samples(spark, samples(spark, tmp_path, ("n1", "2024-01-01", 1), ("n2", "2024-01-01", 1)), star_root, datetime(2024, 1, 1))
    load.append_samples(spark, samples(spark, tmp_path, ("n3", "2024-01-01", 1)), star_root, datetime(2024, 3, 1))
    procedures(spark, star_root, 400, "n2")
    load.retry_orphans(spark, star_root, NOW)
    assert load.expire_waiting(spark, star_root, date(2024, 2, 1)) == ("expired_telemetry", "SUCCESS", 0, 0, 1, "")
    assert {r.procedure_id for r in load.waiting_samples(spark, star_root).collect()} == {"n3"}
    assert {r.procedure_id for r in spark.read.parquet(f"{star_root}/{waiting.EXPIRED}").collect()} == {"n1"}
    assert load.expire_waiting(spark, star_root, date(2024, 2, 1))[4] == 0


def test_a_fact_that_outgrew_its_buckets_is_read_as_plain_files(spark, star_root, monkeypatch):
    """The number of buckets is fixed by the first load, so a bucket grows with the fact; a task must not."""

    def bucketed(table):
        plan = load.read_table(spark, star_root, table).groupBy("procedure_key").count()._jdf.queryExecution().executedPlan().toString()
        return "Bucketed: true" in plan

    assert bucketed(load.TELEMETRY) and bucketed(load.PROCEDURES)
    monkeypatch.setattr(load, "BUCKET_ROWS", 20)
    assert not bucketed(load.TELEMETRY) and len(held(spark, star_root)) == 120
    # The record of the procedures' rows; one without it, from before, stays as it was.
    assert bucketed(load.PROCEDURES)
    with ledger.writing(spark, star_root, load.PROCEDURES) as claim:
        claim.values["rows"] = 81
    assert not bucketed(load.PROCEDURES) and load.read_table(spark, star_root, load.PROCEDURES).count() == 40
