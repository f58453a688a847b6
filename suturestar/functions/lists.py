"""Free-text columns that hold delimited lists ("a, b" complications, "a; b" actions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def items(c: Column, sep: str) -> Column:
    """Array of trimmed, non-empty items; NULL text stays NULL."""
    parts = F.transform(F.split(c, "\\Q" + sep.strip() + "\\E"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def item_rows(df: DataFrame, column: str, sep: str, name: str) -> DataFrame:
    """One row per item of the list in `column`."""
    return df.withColumn(name, F.explode(items(F.col(column), sep)))
