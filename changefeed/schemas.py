"""Names and types of the tables, and values that must stay fixed."""

from __future__ import annotations

# Another namespace would give every event and every quarantined
# record a new id and so break the recognition of redelivered records.
EVENT_ID_NAMESPACE = "5b0f2b8e-4f7c-4c1e-9a53-2f0d8f3c6a17"
QUARANTINE_NAMESPACE = "0c6f0e5a-7d2b-4bb8-8a4e-3f1d7c9b2e61"

# The envelope, version 1.
SCHEMA_VERSION = 1
ENTITY_TYPE_PATTERN = "^[a-z][a-z0-9_]*$"
EVENT_TYPES = ("insert", "update")
ENVELOPE_FIELDS = (
    "schema_version",
    "event_id",
    "event_type",
    "source",
    "entity_type",
    "entity_key",
    "entity_version",
    "occurred_at",
    "captured_at",
    "batch_id",
    "payload",
)
SOURCE_FIELDS = ("system", "object")
MAX_ENTITY_KEY = 512

# Verdicts, outcomes and quarantine reasons.
ACCEPTED = "accepted"
DUPLICATE = "duplicate"
SCHEMA_VIOLATION = "schema_violation"
QUALITY_RULE_FAILED = "quality_rule_failed"
EVENT_ID_CONFLICT = "event_id_conflict"
SINK_REJECTED = "sink_rejected"
APPLIED = "applied"
STALE = "stale"
QUARANTINED = "quarantined"
QUARANTINE_REASONS = (SCHEMA_VIOLATION, QUALITY_RULE_FAILED, EVENT_ID_CONFLICT, SINK_REJECTED)

ERROR = "array<struct<type:string,loc:string,msg:string>>"
VIOLATION = "array<struct<rule:string,field:string,severity:string,message:string>>"


SOURCE_STRUCT = "struct<system:string,object:string>"


def ddl(*tables: dict[str, str]) -> str:
    """Columns as the text that ``schema()`` and ``createDataFrame`` take."""
    return ", ".join(f"`{name}` {kind}" for table in tables for name, kind in table.items())


LOG_RECORD = {
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "key": "binary",
    "value": "binary",
    "headers": "map<string,string>",
}

# One row per record of an epoch with its verdict. The event log is its accepted
# part, so the accepted rows are written once and never copied.
RECORDS = {
    "log_seq": "bigint",
    "event_id": "string",
    "event_type": "string",
    "schema_version": "int",
    "source": SOURCE_STRUCT,
    "entity_type": "string",
    "entity_key": "string",
    "entity_version": "bigint",
    "payload": "string",
    "occurred_at": "timestamp",
    "captured_at": "timestamp",
    "batch_id": "string",
    "fingerprint": "string",
    "quality_warnings": VIOLATION,
    "violations": VIOLATION,
    "errors": ERROR,
    "logged_fingerprint": "string",
    "raw_bytes": "binary",
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "ord": "bigint",
}

EVENT_LOG_COLUMNS = (
    "log_seq",
    "event_id",
    "event_type",
    "schema_version",
    "source",
    "entity_type",
    "entity_key",
    "entity_version",
    "payload",
    "occurred_at",
    "captured_at",
    "processed_at",
    "batch_id",
    "fingerprint",
    "quality_warnings",
    "topic",
    "partition",
    "offset",
)

STATE = {
    "entity_type": "string",
    "entity_key": "string",
    "entity_version": "bigint",
    "payload": "string",
    "source": SOURCE_STRUCT,
    "last_event_id": "string",
    "last_event_type": "string",
    "occurred_at": "timestamp",
    "updated_at": "timestamp",
}

QUARANTINE = {
    "quarantine_seq": "bigint",
    "quarantine_id": "string",
    "reason": "string",
    "details": "string",
    "event_id": "string",
    "entity_type": "string",
    "entity_key": "string",
    "batch_id": "string",
    "ruleset_fingerprint": "string",
    "raw_value": "string",
    "raw_bytes": "binary",
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "quarantined_at": "timestamp",
}

# What a later rule set has judged again, whatever became of it.
REJUDGED = {"quarantine_id": "string", "ruleset_fingerprint": "string"}
OUTCOMES = {"outcome": "string", "records": "bigint"}
OFFSETS = {"topic": "string", "partition": "int", "committed_offset": "bigint"}
COMMIT = {
    "next_seq": "bigint",
    "records": "bigint",
    "committed_at": "timestamp",
    # The last batch taken from each stream.
    "streams": "map<string,bigint>",
}

# One row per capture batch, written before its events are published ...
BATCHES = {
    "source_id": "string",
    "batch_id": "string",
    "batch_no": "bigint",
    "sync_mode": "string",
    "cursor_start_at": "timestamp",
    "cursor_start_key": "string",
    "cursor_end_at": "timestamp",
    "cursor_end_key": "string",
    "upper_bound": "timestamp",
    "row_count": "bigint",
    "inserts": "bigint",
    "updates": "bigint",
    "first_event_id": "string",
    "last_event_id": "string",
    "started_at": "timestamp",
}
# ... and one row per cycle, written last, that commits or fails its batches.
CYCLES = {
    "source_id": "string",
    "status": "string",
    "cursor_at": "timestamp",
    "cursor_key": "string",
    "rows": "bigint",
    "batches": "bigint",
    "last_batch_id": "string",
    "caught_up": "boolean",
    "finished_at": "timestamp",
    "error": "string",
}
RUNNING = "running"
COMMITTED = "committed"
FAILED = "failed"
INTERRUPTED = "found without an end when a later run began"
