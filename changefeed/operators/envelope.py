"""Source rows to change events, and events to log records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.functions import ids
from changefeed.functions.payload import payload_json
from changefeed.functions.times import iso_z
from changefeed.schemas import SCHEMA_VERSION


@dataclass(frozen=True)
class SourceSpec:
    """A source table and its three contract columns."""

    system: str
    object: str
    entity_type: str
    key: str
    version: str
    updated_at: str

    @property
    def source_id(self) -> str:
        return f"{self.system}:{self.object}"


def event_type(version: Column) -> Column:
    # Versions start at 1 and grow with every write, so version 1 is the insert.
    return F.when(version == 1, F.lit("insert")).otherwise(F.lit("update"))


def to_events(
    rows: DataFrame,
    spec: SourceSpec,
    *,
    captured_at: Column,
    batch_id: Column,
    keep: tuple[str, ...] = (),
    payload_columns: list[str] | None = None,
) -> DataFrame:
    """One change event per source row. ``keep`` names columns carried along.

    The payload holds every column of the row, or only ``payload_columns``.
    """
    columns = payload_columns or [name for name in rows.columns if name not in keep]
    key = F.col(spec.key).cast("string")
    version = F.col(spec.version).cast("bigint")
    system, source_object = F.lit(spec.system), F.lit(spec.object)
    return rows.select(
        *keep,
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        ids.event_id(system, source_object, F.lit(spec.entity_type), key, version).alias("event_id"),
        event_type(version).alias("event_type"),
        F.struct(system.alias("system"), source_object.alias("object")).alias("source"),
        F.lit(spec.entity_type).alias("entity_type"),
        key.alias("entity_key"),
        version.alias("entity_version"),
        F.col(spec.updated_at).cast("timestamp").alias("occurred_at"),
        captured_at.alias("captured_at"),
        batch_id.alias("batch_id"),
        payload_json(rows, columns).alias("payload"),
    )


def value_json(payload: Column | None = None) -> Column:
    """The envelope as JSON text, from columns named as the envelope fields."""
    head = F.to_json(
        F.struct(
            "schema_version",
            "event_id",
            "event_type",
            "source",
            "entity_type",
            "entity_key",
            "entity_version",
            iso_z(F.col("occurred_at")).alias("occurred_at"),
            iso_z(F.col("captured_at")).alias("captured_at"),
            "batch_id",
        )
    )
    body = F.col("payload") if payload is None else payload
    return F.concat(
        F.substr(head, F.lit(1), F.length(head) - F.lit(1)), F.lit(',"payload":'), body, F.lit("}")
    )


def headers() -> Column:
    """Correlation ids travel beside the value and survive an unreadable one."""
    return F.create_map(
        F.lit("event_id"), F.col("event_id"),
        F.lit("batch_id"), F.col("batch_id"),
        F.lit("event_type"), F.col("event_type"),
        F.lit("entity_type"), F.col("entity_type"),
        F.lit("schema_version"), F.col("schema_version").cast("string"),
        F.lit("content_type"), F.lit("application/json"),
    )


def to_log_values(events: DataFrame, *keep: str) -> DataFrame:
    """``key``, ``value`` and ``headers`` of a log record for every event."""
    return events.select(
        *keep,
        F.col("entity_key").cast("binary").alias("key"),
        value_json().cast("binary").alias("value"),
        headers().alias("headers"),
    )
