"""Every registered query against its oracle SQL, on the smallest tables."""

import importlib.util
import os
import sys

import pytest

import __spark_entry__ as entry
from tests.compare import compare, oracle_connection

# Queries of the training-data part have tests of their own.
NAMES = sorted(entry.registry.queries())
SLOW = {"full_load_report", "str_telemetry_intake", "scd_changed", "scd_reference", "scd_keys", "join_all_versions"}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(entry.registry.oracle_sql()) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, sf_dir, oracle, name):
    if name in SLOW and os.environ.get("QUICK"):
        pytest.skip("QUICK")
    assert compare(spark, oracle, entry.queries()[name], entry.oracle_sql()[name], sf_dir) is None


def test_entry_returns_the_top_robots(spark):
    """The smallest tables have fewer than ten robots that are current at a current facility."""
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert [r.procedure_count for r in rows] == sorted((r.procedure_count for r in rows), reverse=True)


def test_stands_alone_without_the_training_part(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    spec = importlib.util.spec_from_file_location("entry_alone", entry.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert alone.llm is None and set(alone.queries()) == set(NAMES) == set(alone.oracle_sql())
