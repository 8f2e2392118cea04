"""Deterministic ids and content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changefeed.functions.times import iso_z
from changefeed.schemas import EVENT_ID_NAMESPACE, QUARANTINE_NAMESPACE

UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 9562 version 5 UUID of ``name``, as lower-case text."""
    prefix = F.unhex(F.lit(namespace.replace("-", "")))
    digest = F.sha1(F.concat(prefix, F.encode(name, "UTF-8")))
    # The two top bits of the ninth byte become 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def event_id(
    system: Column, source_object: Column, entity_type: Column, key: Column, version: Column
) -> Column:
    parts = (system, source_object, entity_type, key, version.cast("string"))
    return uuid5(EVENT_ID_NAMESPACE, F.concat_ws("|", *parts))


def event_quarantine_id(event: Column, fingerprint: Column, reason: Column) -> Column:
    name = F.concat(F.lit("event:"), event, F.lit(":"), fingerprint, F.lit(":"), reason)
    return uuid5(QUARANTINE_NAMESPACE, name)


def record_quarantine_id(topic: Column, partition: Column, offset: Column) -> Column:
    name = F.concat(
        F.lit("record:"), topic, F.lit(":"), partition.cast("string"), F.lit(":"),
        offset.cast("string"),
    )
    return uuid5(QUARANTINE_NAMESPACE, name)


def uuid_or_null(text: Column) -> Column:
    """Any usual spelling of a UUID in canonical form, else null."""
    bare = F.replace(F.replace(text, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    hexits = F.lower(F.replace(F.btrim(bare, F.lit("{}")), F.lit("-"), F.lit("")))
    pieces = [F.substring(hexits, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(hexits.rlike("^[0-9a-f]{32}$"), F.concat_ws("-", *pieces))


def json_string(text: Column) -> Column:
    """``text`` as a JSON string literal."""
    wrapped = F.to_json(F.struct(text.alias("s")))  # {"s":"..."}
    # Most keys and names need no escape.
    return F.when(text.rlike(r"^[ !#-\[\]-~]*$"), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(
        F.substr(wrapped, F.lit(6), F.length(wrapped) - F.lit(6))
    )


def fingerprint(
    *,
    event_type: Column,
    system: Column,
    source_object: Column,
    entity_type: Column,
    entity_key: Column,
    entity_version: Column,
    occurred_at: Column,
    payload: Column,
    payload_variant: Column,
) -> Column:
    """SHA-256 over the fields that make two records the same change.

    The text is compact JSON with sorted keys. ``captured_at`` and ``batch_id``
    differ between deliveries of one change and stay out. ``payload`` is the text
    of a variant, which shows 1.0 as 1; where it holds fractional numbers its type
    is added, so that an integer and a float never look alike.
    """
    shape = F.schema_of_variant(payload_variant)
    # One look at the type: it is not kept for a second one inside a condition.
    fractional = shape.rlike("DECIMAL|DOUBLE|FLOAT")
    text = F.concat(
        F.lit('{"entity_key":'), json_string(entity_key),
        F.lit(',"entity_type":'), json_string(entity_type),
        F.lit(',"entity_version":'), entity_version.cast("string"),
        F.lit(',"event_type":'), json_string(event_type),
        F.lit(',"occurred_at":"'), iso_z(occurred_at),
        F.lit('","payload":'), payload,
        F.lit(',"source":{"object":'), json_string(source_object),
        F.lit(',"system":'), json_string(system), F.lit("}}"),
        F.when(fractional, shape).otherwise(F.lit("")),
    )
    return F.sha2(text, 256)
