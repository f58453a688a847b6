"""Raw telemetry documents to typed samples to fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suturestar.functions.timekeys import time_key, wall_clock
from suturestar.operators.rows import one_per_key
from suturestar.schemas import TELEMETRY_STAGE

STAGE_COLUMNS = list(TELEMETRY_STAGE)

# Texts of a JSON value that count as false: false, zero and empty values.
FALSY = ("false", "0", "0.0", "-0", "-0.0", "", "[]", "{}", "null")


def truthy(c: Column) -> Column:
    return F.coalesce(~c.isin(*FALSY), F.lit(False))


def _first(nested: str, flat: str) -> Column:
    return F.coalesce(F.col(nested), F.col(flat))


def _rotation(axis: str) -> Column:
    return F.get_json_object("arm_rotation", f"$.{axis}")


def tag_telemetry(raw: DataFrame) -> DataFrame:
    """The staged columns, plus `reason` and the whole `document` where a record is refused.

    Nested and flat layouts are both read.  A value that does not fit its type becomes NULL; a record
    without a readable timestamp, or that is not a telemetry document at all, is refused.
    """
    at = wall_clock(F.col("timestamp"))
    reason = (
        F.when(F.col("_corrupt").isNotNull(), "malformed document")
        .when(F.col("timestamp").isNull() | (F.col("timestamp") == ""), "missing timestamp")
        .when(at.isNull(), "unreadable timestamp")
    )
    fields = F.struct(*[c for c in raw.columns if c != "_corrupt"])
    document = F.when(reason.isNotNull(), F.coalesce(F.col("_corrupt"), F.to_json(fields)))
    sources = {
        "procedure_id": F.col("procedure_id"),
        "timestamp_key": time_key(at),
        "sample_timestamp": at,
        "arm_position_x": _first("arm_position.x", "arm_position_x"),
        "arm_position_y": _first("arm_position.y", "arm_position_y"),
        "arm_position_z": _first("arm_position.z", "arm_position_z"),
        "arm_rotation_x": _rotation("x"),
        "arm_rotation_y": _rotation("y"),
        "arm_rotation_z": _rotation("z"),
        "force_feedback": F.col("force_feedback"),
        "tool_type": F.col("tool_type"),
        "tool_active": truthy(F.col("tool_active")),
        "camera_zoom": F.col("camera_zoom"),
        "lighting_level": F.col("lighting_level"),
        "system_temperature": _first("system_metrics.temperature", "system_temperature"),
        "motor_current": _first("system_metrics.motor_current", "motor_current"),
        "network_latency_ms": _first("system_metrics.network_latency_ms", "network_latency_ms"),
        "video_fps": _first("system_metrics.video_fps", "video_fps"),
    }
    typed = [sources[name].try_cast(kind).alias(name) for name, kind in TELEMETRY_STAGE.items()]
    return raw.select(*typed, reason.alias("reason"), document.alias("document"))


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples in stage order, refused records with their reason and document)."""
    samples = tagged.filter(F.col("reason").isNull()).select(*STAGE_COLUMNS)
    return samples, tagged.filter(F.col("reason").isNotNull()).select("procedure_id", "reason", "document")


def flatten_telemetry(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_tagged(tag_telemetry(raw))


def prune_to_days(existing: DataFrame, stage: DataFrame) -> DataFrame:
    """`existing` cut to the days between the stage's first and last, when it is partitioned by `sample_date`.

    The two days are literals, so that the other partitions are not even listed.
    """
    if "sample_date" not in existing.columns:
        return existing
    day = F.to_date("sample_timestamp")
    span = stage.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if span["first"] is None:
        return existing.filter("false")
    return existing.filter(F.col("sample_date").between(F.lit(span["first"]), F.lit(span["last"])))


def with_procedure(stage: DataFrame, procedures: DataFrame) -> DataFrame:
    """Samples with their procedure's key, null where the procedure is not there."""
    return stage.join(procedures.select("procedure_id", "procedure_key"), "procedure_id", "left")


def not_held(found: DataFrame, existing: DataFrame) -> DataFrame:
    """One of each (procedure, time) that the fact does not hold; only the days of `found` are looked at.

    Dropping copies and the anti join share one partitioning.
    """
    keys = ["procedure_key", "sample_timestamp"]
    rows = one_per_key(found.drop("procedure_id"), keys).join(prune_to_days(existing, found).select(*keys), keys, "left_anti")
    return rows.select("procedure_key", *[c for c in STAGE_COLUMNS if c != "procedure_id"])


def load_telemetry(stage: DataFrame, procedures: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new fact rows by procedure_key, samples whose procedure is not there)."""
    known = procedures.select("procedure_id", "procedure_key")
    return not_held(stage.join(known, "procedure_id"), existing), stage.join(known.select("procedure_id"), "procedure_id", "left_anti")
