"""The plans themselves: what must hold at any size."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from suturestar.gate import registry, tables
from suturestar.plans.telemetry import load_telemetry
from suturestar.schemas import TELEMETRY_STAGE

LAZY = {**registry.VIEWS, **registry.REPORTS, **registry.LOOKUPS, **registry.QUALITY}
LAZY.pop("val_versions")  # writes
FACT_FIRST = [
    "vw_outcomes_by_robot_model", "vw_surgeon_performance", "vw_surgeon_procedure_categories", "vw_facility_performance",
    "vw_robot_utilization", "vw_robot_utilization_monthly", "vw_telemetry_system_health", "q02_top_robots",
    "q05_outcomes_by_model", "q07_top_surgeons", "q08_experience_bands", "q09_facility_comparison",
    "q10_facility_efficiency", "q11_robot_health",
]


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(LAZY))
def test_no_cross_joins_and_no_sorted_aggregates(spark, sf_dir, name):
    plan = physical(LAZY[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("name", FACT_FIRST)
def test_fact_is_reduced_before_it_meets_growing_dimensions(spark, sf_dir, name):
    """With nothing small enough to broadcast, robots and surgeons still never join the raw fact."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = physical(LAZY[name](spark, sf_dir))
    lines = plan.splitlines()
    joins = [i for i, line in enumerate(lines) if "Join" in line and ("robot_key" in line or "surgeon_key" in line)]
    assert joins
    for i in joins:
        depth = lines[i].index("SortMergeJoin")
        child = []
        for line in lines[i + 1 :]:
            stripped = len(line) - len(line.lstrip(" :+-"))
            if stripped <= depth - 1:
                break
            child.append(line)
        assert any("HashAggregate" in line for line in child)


def test_unused_joins_disappear(spark, sf_dir):
    plan = physical(LAZY["q14_period_growth"](spark, sf_dir))
    assert "lineitem" in plan and "supplier" not in plan and "part.parquet" not in plan
    plan = physical(registry.queries()["c6_fact_sanity"](spark, sf_dir))
    assert "part.parquet" not in plan


def test_windows_reach_the_scan_and_columns_are_pruned(spark, sf_dir):
    plan = physical(LAZY["q12_day_of_week"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,2001-05-03T00:00" in plan
    orders = [line for line in plan.splitlines() if "orders.parquet" in line]
    assert orders and all("o_custkey" not in line.split("ReadSchema")[1] for line in orders)


def test_calendar_is_broadcast_by_size(spark, sf_dir):
    plan = physical(LAZY["vw_robot_utilization_monthly"](spark, sf_dir))
    assert "SortMergeJoin" not in plan


def test_hot_procedure_is_split(spark):
    """A third of the samples belong to one procedure: the join splits its partition, the rows stay whole."""
    n = 60_000
    base = spark.range(n).withColumns(
        {
            "procedure_id": F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 5000).cast("string"))),
            "sample_timestamp": F.timestamp_seconds(F.col("id")).cast("timestamp_ntz"),
        }
    )
    stage = base.select(
        *[
            F.col(c) if c in base.columns else (F.repeat(F.lit("x"), 200) if c == "tool_type" else F.lit(None).cast(t)).alias(c)
            for c, t in TELEMETRY_STAGE.items()
        ]
    )
    procedures = spark.range(5001).select(
        F.when(F.col("id") == 5000, "hot").otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("procedure_id"),
        F.col("id").alias("procedure_key"),
    )
    held = spark.range(10).select(F.lit(-1).cast("bigint").alias("procedure_key"), F.lit(None).cast("timestamp_ntz").alias("sample_timestamp"))
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.shuffle.partitions": "16",
        },
    ):
        rows, _ = load_telemetry(stage, procedures, held)
        assert len(rows.collect()) == n
        assert "skew=true" in physical(rows)


def test_hot_robot_reaches_the_reducer_as_one_row(spark):
    """The first step of a report combines on the map side."""
    from suturestar.functions import measures as m

    fact = spark.range(0, 90_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("robot_key"), F.lit(5).alias("minutes")
    )
    per_robot = m.partials(fact, ["robot_key"], [m.rows("n"), m.hours("h", "minutes")])
    hot = per_robot.filter("robot_key = 0").first()
    assert hot["n_rows__"] == 30_000
    plan = physical(per_robot)
    assert plan.index("partial_count") > plan.index("Exchange")  # printed below the exchange, so run before it


def test_results_do_not_depend_on_broadcasts(spark, sf_dir):
    for name in ("vw_facility_performance", "vw_telemetry_system_health", "q01_platform_metrics"):
        usual = sorted(map(str, LAZY[name](spark, sf_dir).collect()))
        with settings(
            spark,
            **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"},
        ):
            assert sorted(map(str, LAZY[name](spark, sf_dir).collect())) == usual


def test_schema_is_declared_once(spark, sf_dir):
    assert tables._schema(spark, f"{sf_dir}/orders.parquet") is tables._schema(spark, f"{sf_dir}/orders.parquet")


def test_copies_shrink_before_the_shuffle(spark):
    from suturestar.operators.rows import one_per_key

    df = spark.range(100).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = physical(one_per_key(df, ["k"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")
