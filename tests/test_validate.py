from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from changefeed.operators.validate import decode
from tests import model


def _without(name):
    return lambda doc: doc.pop(name)


def _set(name, new):
    return lambda doc: doc.__setitem__(name, new)


INVALID = {
    "missing-event-type": (_without("event_type"), {("missing", "event_type")}),
    "missing-payload": (_without("payload"), {("missing", "payload")}),
    "unknown-event-type": (_set("event_type", "delete"), {("enum", "event_type")}),
    "schema-version": (_set("schema_version", 2), {("literal_error", "schema_version")}),
    "schema-version-text": (_set("schema_version", "1"), {("literal_error", "schema_version")}),
    "naive-time": (_set("occurred_at", "2026-01-01T12:00:00"), {("timezone_aware", "occurred_at")}),
    "clock-word": (_set("captured_at", "now"), {("datetime_parsing", "captured_at")}),
    "empty-key": (_set("entity_key", ""), {("string_too_short", "entity_key")}),
    "numeric-key": (_set("entity_key", 42), {("string_type", "entity_key")}),
    "null-key": (_set("entity_key", None), {("string_type", "entity_key")}),
    "long-key": (_set("entity_key", "x" * 513), {("string_too_long", "entity_key")}),
    "zero-version": (_set("entity_version", 0), {("greater_than_equal", "entity_version")}),
    "huge-version": (_set("entity_version", 2**63), {("less_than_equal", "entity_version")}),
    "float-version": (_set("entity_version", 1.5), {("int_type", "entity_version")}),
    "entity-type": (_set("entity_type", "Order!"), {("string_pattern_mismatch", "entity_type")}),
    "entity-type-newline": (
        _set("entity_type", "order\n"), {("string_pattern_mismatch", "entity_type")},
    ),
    "payload-list": (_set("payload", [1, 2]), {("dict_type", "payload")}),
    "unknown-field": (_set("unexpected", "field"), {("extra_forbidden", "unexpected")}),
    "source-extra": (
        _set("source", {**model.SOURCE, "more": "x"}), {("extra_forbidden", "source.more")},
    ),
    "source-empty": (
        _set("source", {"system": "", "object": "o"}), {("string_too_short", "source.system")},
    ),
    "source-text": (_set("source", "parquet"), {("model_type", "source")}),
    "random-id": (_set("event_id", str(uuid.uuid4())), {("value_error", "")}),
    "no-uuid": (_set("event_id", "abc"), {("uuid_parsing", "event_id")}),
    "uuid-number": (_set("batch_id", 5), {("uuid_type", "batch_id")}),
    "two-problems": (
        lambda doc: (doc.pop("payload"), doc.__setitem__("entity_version", "secret-value")),
        {("missing", "payload"), ("int_type", "entity_version")},
    ),
}


def _decode(spark, records):
    return {row["offset"]: row for row in decode(model.log(spark, records)).drop(
        "payload_variant").collect()}


def test_invalid_envelopes_name_field_and_kind(spark):
    records, expected = [], {}
    for offset, (mutate, errors) in enumerate(INVALID.values()):
        document = model.event()
        mutate(document)
        records.append(model.record(document, offset))
        expected[offset] = errors
    found = _decode(spark, records)
    names = list(INVALID)
    for offset, row in found.items():
        assert {(e["type"], e["loc"]) for e in row["errors"]} == expected[offset], names[offset]
        assert row["event_type"] is None and row["payload"] is None
        assert "secret-value" not in json.dumps([e.asDict() for e in row["errors"]])


def test_unreadable_values(spark):
    good = json.dumps(model.event())
    cases = [
        (None, "missing_value"),
        (b'{"event_id": "not closed', "json_invalid"),
        (b"\xff\xfe{}", "json_invalid"),
        (b"", "json_invalid"),
        (b"[1]", "model_type"),
        (b'"text"', "model_type"),
        (f"{good} x".encode(), "json_invalid"),
        (f"{good}{good}".encode(), "json_invalid"),
        (f"{good},{good}".encode(), "json_invalid"),
        (f"{good}]".encode(), "json_invalid"),
        (good.replace('"v1"', '"\\ud800"').encode(), "json_invalid"),
        (good.replace('"v1"', "NaN").encode(), "json_invalid"),
        (good.replace('"', "'").encode(), "json_invalid"),
    ]
    found = _decode(spark, [model.record(raw, i) for i, (raw, _) in enumerate(cases)])
    for offset, (raw, kind) in enumerate(cases):
        assert [e["type"] for e in found[offset]["errors"]] == [kind], raw


def test_valid_spellings_are_accepted(spark):
    plain = model.event()
    upper = {**plain, "event_id": plain["event_id"].upper(), "batch_id": plain["batch_id"].upper()}
    shifted = {**plain, "occurred_at": "2025-11-03T10:52:00+02:00"}
    escaped = json.dumps(model.event(key=2, payload=model.payload(2, o_comment="é\\\"\n😀")))
    pretty = json.dumps(plain, indent=2)
    repeated = json.dumps(plain)[:-1] + ', "entity_version": 1}'
    spaced = "  " + json.dumps(plain) + " \n"
    texts = [json.dumps(plain), json.dumps(upper), json.dumps(shifted), escaped, pretty, repeated,
             spaced]
    found = _decode(spark, [model.record(t.encode(), i) for i, t in enumerate(texts)])
    assert [found[i]["errors"] for i in range(len(texts))] == [[]] * len(texts)
    for i in (0, 1, 2, 4, 5, 6):
        assert found[i]["event_id"] == plain["event_id"], i
        assert found[i]["occurred_at"] == found[0]["occurred_at"], i
        assert json.loads(found[i]["payload"]) == plain["payload"], i
        assert found[i]["source"].asDict() == model.SOURCE


def test_headers_and_key_tell_about_unreadable_records(spark):
    event_id, batch_id = str(uuid.uuid4()), str(uuid.uuid4())
    headers = {"event_id": event_id.upper(), "batch_id": batch_id}
    rows = _decode(
        spark,
        [
            model.record(b"garbage", 0, key=b"k\x00\xfe", headers=headers),
            model.record(b"garbage", 1, headers={"event_id": "no uuid"}),
        ],
    )
    assert (rows[0]["event_id"], rows[0]["batch_id"]) == (event_id, batch_id)
    assert rows[0]["entity_key"] == "k\0�"
    assert rows[1]["event_id"] is None and rows[1]["entity_type"] is None


def test_fingerprint_is_that_of_the_canonical_json(spark):
    from changefeed.operators.resolve import examine
    from changefeed.operators.rules import RuleSet

    documents = [
        model.event(),
        model.event(captured=model.T0, batch_id=str(uuid.uuid4())),
        model.event(payload={"b": [1, {"z": None, "a": True}], "a": 'é "x"\n'}),
        model.event(payload={"n": 1}),
        model.event(payload={"n": 1.0}),
    ]
    rows = examine(
        model.log(spark, [model.record(d, i) for i, d in enumerate(documents)]), RuleSet({})
    )
    found = {r["offset"]: r["fingerprint"] for r in rows.select("offset", "fingerprint").collect()}
    for offset in (0, 1, 2, 3):
        assert found[offset] == model.fingerprint(documents[offset])
    assert found[0] == found[1]
    assert found[3] != found[4], "1 and 1.0 are different contents"


def test_no_record_is_lost(spark):
    records = [model.record(model.event(k), k) for k in range(5)] + [model.record(None, 9)]
    rows = decode(model.log(spark, records))
    assert rows.count() == 6
    assert rows.where(F.size("errors") > 0).count() == 1
