"""Raw telemetry as VARIANT: a record keeps every field it came with, and typed columns are cut from it afterwards.

A schema given at ingest loses fields that it doesn't name; here a field that appears tomorrow can be queried in records
that were landed today.  Records lie in day partitions, so that a query of some days lists only these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from suturestar.functions.timekeys import wall_clock
from suturestar.schemas import TELEMETRY_DOCUMENT_DDL
from suturestar.sources.readers import CORRUPT

RECORD = "document variant, sample_date date"


def field(path: str, kind: str, document: str = "document") -> Column:
    """The value at a JSON path, typed; NULL where it is missing or doesn't fit."""
    return F.try_variant_get(F.col(document), path, kind)


def parsed(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`document`, `sample_date` of every record, `reason`, `document` as text of what is none), from lines `value`.

    A line holds one object or an array of objects; blank lines hold nothing.  What doesn't parse, repeats a name within
    an object, or is neither is refused.  Records without a readable timestamp stay, their day is NULL.
    """
    tried = lines.filter(F.trim("value") != "").select("value", F.try_parse_json("value").alias("line"))
    several = F.try_variant_get("line", "$", "array<variant>")
    parts = tried.select("value", F.explode(F.coalesce(several, F.array("line"))).alias("document"))
    whole = field("$", "map<string, variant>").isNotNull()
    day = F.to_date(wall_clock(field("$.timestamp", "string"))).alias("sample_date")
    text = F.coalesce(F.col("document").cast("string"), "value").alias("document")
    refused = parts.filter(~whole).select(F.lit("malformed document").alias("reason"), text)
    return parts.filter(whole).select("document", day), refused


def land_raw(lines: DataFrame, landing: str, batch_id: int) -> None:
    """One batch of lines below `landing`: `raw` holds its records, `rejected` the rest.  A replay overwrites the batch."""
    records, refused = parsed(lines)
    records.write.mode("overwrite").partitionBy("sample_date").parquet(f"{landing}/raw/batch_id={batch_id}")
    refused.write.mode("overwrite").json(f"{landing}/rejected/batch_id={batch_id}")


def read_raw(spark: SparkSession, landing: str) -> DataFrame:
    """Every landed record: `document` and `sample_date`."""
    return spark.read.schema(RECORD).parquet(f"{landing}/raw").select("document", "sample_date")


def documents(raw: DataFrame) -> DataFrame:
    """Landed records with the columns that `read_telemetry` gives, for `flatten_telemetry`."""
    declared = [f for f in StructType.fromDDL(TELEMETRY_DOCUMENT_DDL).fields if f.name != CORRUPT]
    cut = field("$", StructType(declared).simpleString())
    return raw.select(cut.alias("d")).select("d.*", F.lit(None).cast("string").alias(CORRUPT))
