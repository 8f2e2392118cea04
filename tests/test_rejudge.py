"""A rule set changes: what it let wait against a rebuild under the new rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changefeed.operators.rules import parse_rules
from changefeed.plans.materialize import resolve_epoch
from changefeed.plans.replay import rejudge, waiting_for
from changefeed.streaming.tables import Tables
from tests import model


def at_most(bound):
    rule = {
        "name": "price_bound", "description": "A bound.", "field": "o_totalprice", "severity": "reject",
        "check": "max", "value": bound,
    }
    return parse_rules({"version": 1, "entities": {"order": [rule]}})


STRICT, WIDER, WIDEST = at_most(100), at_most(500), at_most(9_000)


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "sink"))


def priced(key, version, price, offset, **changes):
    doc = model.event(key, version, payload=model.payload(key, o_totalprice=str(price), **changes))
    return model.record(doc, offset)


LOG = [
    priced(1, 1, 90, 0),  # accepted at once
    priced(1, 2, 300, 1),  # waits for 500
    priced(1, 3, 80, 2),  # accepted at once, newer than what waits
    priced(2, 1, 400, 3),
    priced(2, 1, 400, 4),  # the same event again
    priced(2, 1, 450, 5),  # the same id with other content
    priced(3, 1, 700, 6),  # waits for 9000
    priced(4, 1, 200, 7, o_comment="a\0b"),  # breaks the rule, and cannot be stored either
    model.record(b"not json", 8),
    priced(5, 2, 150, 9),
    priced(5, 1, 120, 10),
]


def content(tables):
    log = {(r["event_id"], r["fingerprint"]) for r in tables.event_log().collect()}
    state = {
        (r["entity_key"], r["entity_version"], r["last_event_id"], r["payload"])
        for r in tables.current_state().collect()
    }
    return log, state


def reasons(tables):
    rows = tables.quarantine().groupBy("reason").agg(F.count("*").alias("n")).collect()
    return {r["reason"]: r["n"] for r in rows}


def test_ids_that_were_not_logged_end_as_in_a_rebuild(spark, tables, tmp_path):
    log = model.log(spark, LOG)
    resolve_epoch(log, tables, STRICT)
    assert reasons(tables) == {"quality_rule_failed": 7, "schema_violation": 1}
    for number, (rules, waited) in enumerate([(WIDER, 7), (WIDEST, 2)]):
        # The second time: 700 still breaks a rule, the text with NUL cannot be stored;
        # the other content of order 2 meets a logged id and does not run again.
        assert rejudge(tables, rules) == waited
        rebuilt = Tables(spark, str(tmp_path / f"rebuilt-{number}"))
        resolve_epoch(log, rebuilt, rules)
        assert content(tables) == content(rebuilt)
        assert rejudge(tables, rules) == 0 and waiting_for(tables, rules).isEmpty()
    assert reasons(tables) == {
        "quality_rule_failed": 7, "schema_violation": 1, "event_id_conflict": 1, "sink_rejected": 1,
    }
    assert tables.event_log().select("log_seq").distinct().count() == tables.event_log().count()
    offsets = {r["committed_offset"] for r in tables.committed_offsets().collect()}
    assert offsets == {11}, "the position in the log does not go back"


def test_accepted_events_stay_under_stricter_rules(spark, tables):
    resolve_epoch(model.log(spark, LOG), tables, WIDEST)
    before = content(tables)
    assert rejudge(tables, STRICT) == 0
    assert content(tables) == before


def test_logged_ids_do_not_run_again(spark, tables):
    resolve_epoch(model.log(spark, [priced(1, 1, 300, 0), priced(1, 1, 50, 1)]), tables, STRICT)
    before = content(tables)
    assert rejudge(tables, WIDER) == 0
    assert content(tables) == before


def test_a_lost_note_runs_the_events_once_more(spark, tables):
    resolve_epoch(model.log(spark, LOG), tables, STRICT)
    rejudge(tables, WIDER)
    before, found = content(tables), reasons(tables)
    spark.createDataFrame([], "quarantine_id string, ruleset_fingerprint string").write.mode(
        "overwrite"
    ).parquet(tables.path("rejudged", 1))
    assert rejudge(tables, WIDER) == 2
    assert content(tables) == before and reasons(tables) == found


def test_empty_tables(spark, tables):
    assert rejudge(tables, STRICT) == 0
