from datetime import datetime

import pytest
from pyspark.sql import functions as F

from suturestar.operators import quality
from suturestar.plans import lookups
from suturestar.schemas import OPERATIONAL_DDL, nullable, schema_of


@pytest.mark.parametrize("table", OPERATIONAL_DDL)
def test_every_rule_of_the_model_is_broken_once(spark, table):
    """A row of nulls breaks each NOT NULL rule, a row of long texts each VARCHAR rule; NULL passes the others."""
    empty = spark.createDataFrame([[None] * len(schema_of(table).fields)], nullable(schema_of(table)))
    long = empty.withColumns({c: F.lit("x" * (n + 1)) for c, n in quality.LENGTHS[table].items()})
    rules = quality.model_rules(table)
    nulls = {r.rule for r in quality.violation_counts(empty, rules).filter("violations = 1").collect()}
    assert nulls == {f"{c} is null" for c in quality.required_columns(table)}
    assert quality.required_columns(table) == [f.name for f in schema_of(table).fields if not f.nullable]
    counts = {r.rule: r.violations for r in quality.violation_counts(empty.unionByName(long), rules).collect()}
    assert counts.keys() == rules.keys()
    assert all(counts[f"{c} longer than {n}"] == 1 for c, n in quality.LENGTHS[table].items())
    listed = quality.validate(empty.unionByName(long), rules, []).groupBy("rule").count().collect()
    assert {r.rule: r["count"] for r in listed} == {k: v for k, v in counts.items() if v}
    assert all(r.violations == 0 for r in quality.violation_counts(empty.limit(0), rules).collect())


def test_counts_take_one_scan(spark):
    df = spark.createDataFrame([], nullable(schema_of("surgical_procedures")))
    counts = quality.violation_counts(df, quality.model_rules("surgical_procedures"))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_pages_by_token_equal_offsets(spark):
    """Ties in the time and times that are missing are passed once each."""
    times = [datetime(2024, 1, 1 + k % 3, 8) if k % 5 else None for k in range(23)]
    rows = [(f"P{k:02}", t, "completed", "r", "c") for k, t in enumerate(times)]
    schema = "procedure_id string, start_time timestamp_ntz, status string, robot_id string, procedure_category string"
    tables = {"surgical_procedures": spark.createDataFrame(rows, schema)}
    whole = [r.procedure_id for r in lookups.procedures(tables, limit=100).collect()]
    got, token = [], None
    while True:
        part = lookups.procedures(tables, limit=4, after=token)
        token = lookups.last_of(part)
        if token is None:
            break
        got += [r.procedure_id for r in part.collect()]
    assert got == whole and len(got) == 23
    deep = lookups.procedures(tables, limit=4, after=(times[1], "P01"))
    assert "TakeOrderedAndProject(limit=4" in deep._jdf.queryExecution().executedPlan().toString()
