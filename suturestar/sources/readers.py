"""Operational tables and telemetry documents as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from suturestar.schemas import OPERATIONAL_DDL, TELEMETRY_DOCUMENT_DDL, nullable, schema_of

CORRUPT = "_corrupt"


def read_csv_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Headered comma CSV in the table's column order."""
    return (
        spark.read.schema(nullable(schema_of(table)))
        .option("header", True)
        .option("enforceSchema", False)
        .option("timestampNTZFormat", "yyyy-MM-dd[ HH:mm:ss][.SSSSSS]")
        .csv(path)
    )


def read_staged_csv(
    spark: SparkSession, path: str, schema: StructType | str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
) -> DataFrame:
    """Pipe-delimited CSV without a header: quotes removed, empty fields NULL, ISO dates."""
    return (
        spark.read.schema(nullable(StructType.fromDDL(schema) if isinstance(schema, str) else schema))
        .option("sep", "|")
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", timestamp_format)
        .csv(path)
    )


def read_operational(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Every operational table below `root`, parquet or headered CSV."""
    if fmt == "csv":
        return {t: read_csv_table(spark, f"{root}/{t}.csv", t) for t in OPERATIONAL_DDL}
    return {t: spark.read.format(fmt).load(f"{root}/{t}") for t in OPERATIONAL_DDL}


def read_operational_jdbc(
    spark: SparkSession, url: str, properties: Mapping[str, str], partitions: Mapping[str, tuple[str, object, object, int]]
) -> dict[str, DataFrame]:
    """Every operational table over JDBC, split into range reads where `partitions` gives
    (column, lower, upper, number) for the table."""
    out = {}
    for table in OPERATIONAL_DDL:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
        if table in partitions:
            column, lower, upper, n = partitions[table]
            reader = (
                reader.option("partitionColumn", column)
                .option("lowerBound", str(lower))
                .option("upperBound", str(upper))
                .option("numPartitions", n)
            )
        out[table] = reader.load()
    return out


def telemetry_options(multi_line: bool = False) -> dict[str, str]:
    return {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "pathGlobFilter": "*.{json,json.gz}",
        "recursiveFileLookup": "true",
        "multiLine": str(multi_line).lower(),
    }


def read_telemetry(spark: SparkSession, *paths: str, multi_line: bool = False) -> DataFrame:
    """Telemetry documents from `.json` or `.json.gz` files: one object, one array or one record per line.

    A record that does not parse keeps its text in `_corrupt`; the rest of its file is read.  Files that
    hold one document over several lines need `multi_line=True`, which gives up splitting files.
    """
    return spark.read.schema(TELEMETRY_DOCUMENT_DDL).options(**telemetry_options(multi_line)).json(list(paths))
