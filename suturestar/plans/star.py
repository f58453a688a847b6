"""The star as a bundle of DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "dim_date",
    "dim_time",
    "dim_facilities",
    "dim_surgeons",
    "dim_robots",
    "fact_procedures",
    "fact_procedure_telemetry",
)

Table = DataFrame | Callable[[], DataFrame]


class Star:
    """Five dimensions and two facts, each given as a DataFrame or as a function that builds it on first use.

    Contract, as the primary keys of the model declare it: `*_key` is unique within its table.  Views
    rely on it where they count rows instead of distinct procedure keys; `quality.unique_violations`
    checks it.
    """

    def __init__(self, **tables: Table) -> None:
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise ValueError(f"not star tables: {sorted(unknown)}")
        self._tables = tables

    def _get(self, name: str) -> DataFrame:
        table = self._tables[name]
        return table if isinstance(table, DataFrame) else table()

    dim_date = cached_property(lambda self: self._get("dim_date"))
    dim_time = cached_property(lambda self: self._get("dim_time"))
    dim_facilities = cached_property(lambda self: self._get("dim_facilities"))
    dim_surgeons = cached_property(lambda self: self._get("dim_surgeons"))
    dim_robots = cached_property(lambda self: self._get("dim_robots"))
    fact_procedures = cached_property(lambda self: self._get("fact_procedures"))
    fact_procedure_telemetry = cached_property(lambda self: self._get("fact_procedure_telemetry"))

    def current(self, dim: str) -> DataFrame:
        return getattr(self, dim).filter("is_current")

    def completed(self) -> DataFrame:
        return self.fact_procedures.filter(F.col("status") == "completed")

    def completed_since(self, first: date) -> DataFrame:
        """Completed procedures from a day on; a loaded fact is partitioned by month, which this prunes."""
        facts, day = self.completed(), first.year * 10000 + first.month * 100 + first.day
        if "start_month" in facts.columns:
            facts = facts.filter(F.col("start_month") >= day // 100)
        return facts.filter(F.col("start_date_key") >= day)

    def register(self, spark: SparkSession) -> None:
        """Temp views under the tables' own names, for callers who write SQL."""
        for name in self._tables:
            getattr(self, name).createOrReplaceTempView(name)
