"""Events built in plain Python and a record-by-record model of the verdicts."""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import UTC, datetime, timedelta
from typing import Any

from changefeed.schemas import EVENT_ID_NAMESPACE, LOG_RECORD, ddl

T0 = datetime(2025, 11, 3, 7, 45, tzinfo=UTC)
SOURCE = {"system": "parquet", "object": "orders"}
TOPIC = "test"


def iso(moment: datetime) -> str:
    return moment.astimezone(UTC).isoformat().replace("+00:00", "Z")


def event_id(entity_type: str, key: str, version: int, source: dict[str, str] = SOURCE) -> str:
    name = "|".join((source["system"], source["object"], entity_type, key, str(version)))
    return str(uuid.uuid5(uuid.UUID(EVENT_ID_NAMESPACE), name))


# The first columns of the orders table, with one row's values.
ORDER = {
    "o_orderkey": 0, "o_custkey": 370, "o_orderstatus": "F", "o_totalprice": "1723.66",
    "o_orderdate": "1994-07-30", "o_comment": "final accounts",
}


def payload(key: int, **changes: Any) -> dict[str, Any]:
    return ORDER | {"o_orderkey": key} | changes


def event(key: int = 1, version: int = 1, **changes: Any) -> dict[str, Any]:
    occurred = changes.pop("occurred", T0 + timedelta(minutes=7 * version, hours=key % 11))
    captured = changes.pop("captured", occurred + timedelta(minutes=3, seconds=20))
    entity_type = changes.pop("entity_type", "order")
    source = changes.pop("source", SOURCE)
    return {
        "schema_version": 1,
        "event_id": event_id(entity_type, str(key), version, source),
        "event_type": "insert" if version == 1 else "update",
        "source": source,
        "entity_type": entity_type,
        "entity_key": str(key),
        "entity_version": version,
        "occurred_at": iso(occurred),
        "captured_at": iso(captured),
        "batch_id": changes.pop("batch_id", str(uuid.uuid5(uuid.NAMESPACE_OID, f"{key}{version}"))),
        "payload": changes.pop("payload", payload(key, o_comment=f"v{version}")),
        **changes,
    }


def value(document: Any) -> bytes:
    return json.dumps(document, ensure_ascii=False).encode()


def record(document: Any, offset: int, partition: int = 0, **changes: Any) -> tuple:
    raw = document if document is None or isinstance(document, bytes) else value(document)
    key = changes.get("key", b"1")
    if isinstance(document, dict) and "entity_key" in document and "key" not in changes:
        key = str(document["entity_key"]).encode()
    headers = changes.get("headers", {})
    return (TOPIC, partition, offset, bytearray(key), raw and bytearray(raw), headers)


def log(spark: Any, records: list[tuple]) -> Any:
    return spark.createDataFrame(records, ddl(LOG_RECORD))


def fingerprint(document: dict[str, Any]) -> str:
    fields = (
        "event_type", "source", "entity_type", "entity_key", "entity_version", "occurred_at",
        "payload",
    )
    content = {name: document[name] for name in fields}
    text = json.dumps(content, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()


def acceptable(document: dict[str, Any]) -> str | None:
    """Why an event may not be logged: the rules that tests use, and NUL."""
    row = document["payload"]
    price = row.get("o_totalprice")
    if price is None or float(price) < 0 or row.get("o_orderstatus") not in ("O", "F", "P", None):
        return "quality_rule_failed"
    return "sink_rejected" if "\0" in json.dumps(row, ensure_ascii=False) or any(
        isinstance(v, str) and "\0" in v for v in row.values()
    ) else None


class Model:
    """Processes records one after the other, as the definition says."""

    def __init__(self) -> None:
        self.known: dict[str, str] = {}
        self.state: dict[tuple[str, str], tuple[int, str]] = {}
        self.quarantined: set[tuple] = set()

    def process(self, documents: list[tuple[int, int, dict[str, Any]]]) -> dict[tuple, str]:
        verdicts = {}
        for partition, offset, doc in sorted(documents, key=lambda item: item[:2]):
            verdicts[(partition, offset)] = self._one(doc)
        return verdicts

    def _one(self, doc: dict[str, Any]) -> str:
        found, print_ = doc["event_id"], fingerprint(doc)
        if found in self.known:
            if self.known[found] == print_:
                return "duplicate"
            self.quarantined.add((found, print_, "event_id_conflict"))
            return "event_id_conflict"
        reason = acceptable(doc)
        if reason is not None:
            self.quarantined.add((found, print_, reason))
            return reason
        self.known[found] = print_
        entity, version = (doc["entity_type"], doc["entity_key"]), doc["entity_version"]
        if version > self.state.get(entity, (0, ""))[0]:
            self.state[entity] = (version, found)
            return "applied"
        return "stale"
