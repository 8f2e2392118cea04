from __future__ import annotations

import base64
import json
import uuid
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changefeed.functions import ids, text, times
from changefeed.functions.payload import UnsupportedColumn, payload_json
from changefeed.schemas import EVENT_ID_NAMESPACE


def test_uuid5_equals_the_standard_library(spark):
    names = [f"name|{i}|é✓" for i in range(200)] + [""]
    df = spark.createDataFrame([(name,) for name in names], "name string")
    rows = df.select("name", ids.uuid5(EVENT_ID_NAMESPACE, F.col("name")).alias("id")).collect()
    assert all(r["id"] == str(uuid.uuid5(uuid.UUID(EVENT_ID_NAMESPACE), r["name"])) for r in rows)


def test_header_uuids_in_every_spelling(spark):
    plain = "5b0f2b8e-4f7c-4c1e-9a53-2f0d8f3c6a17"
    good = [plain, plain.upper(), plain.replace("-", ""), "{" + plain + "}", "urn:uuid:" + plain]
    bad = [plain[:-1], "not a uuid", "", None]
    df = spark.createDataFrame([(v,) for v in good + bad], "v string")
    found = [r[0] for r in df.select(ids.uuid_or_null(F.col("v"))).collect()]
    assert found == [plain] * len(good) + [None] * len(bad)


def test_readable_text_replaces_what_text_cannot_hold(spark):
    df = spark.createDataFrame(
        [(bytearray(b"not json\x00\xff"),), (bytearray("né".encode()),), (None,)], "raw binary"
    )
    found = [r[0] for r in df.select(text.readable(F.col("raw"))).collect()]
    assert found == ["not json��", "né", None]


def test_python_repr_quotes_as_messages_do(spark):
    values = ["X", "it's", 'say "x"', "both ' and \"", "line\nbreak\\", "", "\x00\x1b\x7f\x85\xa0", "a\u200bb\u2028",
              "\U000e0001 𝒳é", "\tt\r", "\xad'"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(text.python_repr(F.col("v"))).collect()] == [
        repr(v) for v in values
    ]


def test_page_tokens_round_trip_and_refuse_nonsense(spark):
    df = spark.createDataFrame([(n,) for n in (0, 7, 2**60)], "n bigint")
    for row in df.select("n", text.page_token(F.col("n")).alias("t")).collect():
        assert row["t"] == base64.urlsafe_b64encode(
            json.dumps({"before": row["n"]}).encode()
        ).decode()
    bad = ["%%%", base64.urlsafe_b64encode(b'{"before": "5"}').decode(),
           base64.urlsafe_b64encode(b'{"before": true}').decode(),
           base64.urlsafe_b64encode(b'{"x": 5}').decode(),
           base64.urlsafe_b64encode(b"[1]").decode()]
    tokens = spark.createDataFrame([(t,) for t in bad], "t string")
    assert [r[0] for r in tokens.select(text.page_position(F.col("t"))).collect()] == [None] * 5


def test_dates_are_gated_by_their_shape(spark):
    df = spark.createDataFrame(
        [(v,) for v in ("1996-03-01", "today", "2026", "2026-1-1", "19960301", "1996-13-01")],
        "v string",
    )
    found = [r[0] for r in df.select(times.parse_iso_date(F.col("v"))).collect()]
    assert found == [date(1996, 3, 1), None, None, None, date(1996, 3, 1), None]


DAYS = ["2025-W01-1", "2025W011", "2025-W01", "2020-W53-7", "2021-W53-1", "2025-W00-1", "2025-W01-8", "2024-12-30",
        "0000-01-01", "2025-W1", "20250101", "2025-0101"]
MOMENTS = ["2026-01-01T00", "20250101T000000", "2025-W01-1T10:30", "2025-02-28T235959.1234567", "2025-02-28 23:59:59,5Z",
           "2025-02-28T12:00+05:30", "2025-02-28T12:00-0030", "2025-02-28T12+01:02:03", "2025-02-28T24:01", "2025-02-28T12:0",
           "2025-02-28T1200:30", "2025-02-30T12:00", "2025-02-28T", "x", "2025W01T10", "2025-02-28T12:60"]


def test_iso_forms_are_read_as_the_standard_library_reads_them(spark):
    def read(parse, value):
        try:
            return parse(value)
        except ValueError:
            return None

    df = spark.createDataFrame([(v,) for v in DAYS], "v string").select("v", times.parse_iso_date(F.col("v")).alias("d"))
    assert {r["v"]: r["d"] for r in df.collect()} == {v: read(date.fromisoformat, v) for v in DAYS}

    def utc(value):
        moment = datetime.fromisoformat(value)
        return (moment if moment.tzinfo else moment.replace(tzinfo=UTC)).timestamp()

    found = spark.createDataFrame([(v,) for v in MOMENTS], "v string").select(
        "v", F.unix_micros(times.parse_iso_timestamp(F.col("v"))).alias("t"))
    got = {r["v"]: None if r["t"] is None else r["t"] / 1e6 for r in found.collect()}
    assert got == {v: read(utc, v) for v in MOMENTS}


def test_payload_types(spark):
    df = spark.createDataFrame(
        [(Decimal("1234.50"), Decimal("-0.01"), date(1995, 3, 1), datetime(2026, 1, 1, 8, 30),
          bytearray(b"\0\x01"), float("nan"), 1.5, None, True, "é")],
        "A decimal(12,2), B decimal(4,2), C date, D timestamp_ntz, E binary, F double, G double,"
        " H string, I boolean, J string",
    )
    found = json.loads(df.select(payload_json(df).alias("p")).first()["p"])
    assert found == {
        "a": "1234.50", "b": "-0.01", "c": "1995-03-01", "d": "2026-01-01T08:30:00+00:00",
        "e": "AAE=", "f": "nan", "g": 1.5, "h": None, "i": True, "j": "é",
    }


def test_nested_source_columns_are_refused(spark):
    df = spark.createDataFrame([([1],)], "a array<int>")
    with pytest.raises(UnsupportedColumn):
        payload_json(df)
