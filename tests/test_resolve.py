from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from changefeed.operators import positions, resolve, skew
from changefeed.operators.rules import load_rules
from changefeed.plans.materialize import resolve_epoch
from changefeed.plans.replay import checksums
from changefeed.streaming.tables import Tables
from tests import model


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "sink"))


def sums_of(tables):
    return {row["measure"]: row["value"] for row in checksums(tables).collect()}


def epoch(spark, tables, records):
    number = tables.last_commit().epoch + 1
    resolve_epoch(model.log(spark, records), tables, load_rules(), number)
    rows = tables.epoch_outcomes(number).collect()
    return {row["outcome"]: row["records"] for row in rows}


def feed(*documents, start=0):
    return [model.record(d, start + i) for i, d in enumerate(documents)]


def bad(key=1, version=1, **changes):
    return model.event(key, version, payload=model.payload(key, **changes))


def test_versions_in_order_are_applied(spark, tables):
    assert epoch(spark, tables, feed(model.event(), model.event(1, 2))) == {"applied": 2}
    [row] = tables.current_state().collect()
    assert (row["entity_version"], row["last_event_type"]) == (2, "update")


def test_redeliveries_within_and_across_epochs(spark, tables):
    again = {**model.event(), "captured_at": "2026-01-02T00:00:00Z", "batch_id": str(uuid.uuid4())}
    first = epoch(spark, tables, feed(model.event(), model.event()))
    assert first == {"applied": 1, "duplicate": 1}
    assert epoch(spark, tables, feed(model.event(), again, start=5)) == {"duplicate": 2}
    assert tables.event_log().count() == 1
    assert tables.duplicates_skipped() == 3


def test_older_versions_are_logged_but_stale(spark, tables):
    events = [model.event(1, v) for v in (3, 1, 2)]
    assert epoch(spark, tables, feed(*events)) == {"applied": 1, "stale": 2}
    assert epoch(spark, tables, feed(model.event(1, 4), start=9)) == {"applied": 1}
    assert tables.event_log().count() == 4
    assert tables.current_state().first()["entity_version"] == 4


def test_conflicts_go_to_quarantine_and_leave_the_state(spark, tables):
    tampered = bad(o_comment="tampered")
    assert epoch(spark, tables, feed(model.event(), tampered)) == {"applied": 1, "quarantined": 1}
    before = sums_of(tables)
    assert epoch(spark, tables, feed(tampered, tampered, start=5)) == {"quarantined": 2}
    assert sums_of(tables) == before, "the same rejected content is kept once"
    [row] = tables.quarantine().collect()
    assert row["reason"] == "event_id_conflict"
    assert model.fingerprint(tampered) in row["details"]


def test_rejected_first_record_does_not_make_the_id_known(spark, tables):
    records = feed(bad(o_totalprice="-1.00"), model.event(), bad(o_totalprice="-1.00"))
    assert epoch(spark, tables, records) == {"applied": 1, "quarantined": 2}
    reasons = {row["reason"] for row in tables.quarantine().collect()}
    assert reasons == {"quality_rule_failed", "event_id_conflict"}


def test_warnings_are_kept_on_the_event(spark, tables):
    assert epoch(spark, tables, feed(bad(o_comment="x" * 100))) == {"applied": 1}
    [row] = tables.event_log().collect()
    assert [w["rule"] for w in row["quality_warnings"]] == ["comment_within_source_limit"]


def test_raw_bytes_survive_in_quarantine(spark, tables):
    raw = b"not json\x00\xff"
    assert epoch(spark, tables, [model.record(raw, 3, key=b"k\x00\xfe")]) == {"quarantined": 1}
    [row] = tables.quarantine().collect()
    assert bytes(row["raw_bytes"]) == raw
    assert row["raw_value"] == "not json��"
    assert (row["reason"], row["ruleset_fingerprint"]) == ("schema_violation", None)
    assert row["quarantine_id"] == str(
        uuid.uuid5(uuid.UUID("0c6f0e5a-7d2b-4bb8-8a4e-3f1d7c9b2e61"), "record:test:0:3")
    )


def test_nul_is_refused_and_the_next_record_applied(spark, tables):
    records = feed(bad(o_comment="a\0b"), bad(2, o_comment="a\\u0000b"), model.event(3))
    assert epoch(spark, tables, records) == {"applied": 2, "quarantined": 1}
    assert tables.quarantine().first()["reason"] == "sink_rejected"


def test_equal_versions_of_two_sources_keep_the_first(spark, tables):
    other = model.event(source={"system": "parquet", "object": "copy"})
    assert epoch(spark, tables, feed(model.event(), other)) == {"applied": 1, "stale": 1}
    assert tables.current_state().first()["last_event_id"] == model.event()["event_id"]


def test_sequence_numbers_follow_the_log_and_epochs(spark, tables):
    epoch(spark, tables, [model.record(model.event(k), k, partition=k % 2) for k in range(1, 6)])
    epoch(spark, tables, [model.record(model.event(k), k, partition=k % 2) for k in range(6, 9)])
    rows = tables.event_log().orderBy("log_seq").collect()
    assert len({r["log_seq"] for r in rows}) == 8
    first = [(r["partition"], r["offset"]) for r in rows[:5]]
    assert first == sorted(first)
    assert {r["entity_key"] for r in rows[5:]} == {"6", "7", "8"}


def random_feed(seed, records):
    """Few keys, many copies; one event holds a third of all records."""
    rng = random.Random(seed)
    documents, used = [], {0: 0, 1: 0, 2: 0}
    for _ in range(records):
        if rng.random() < 0.33:
            doc = model.event(0, 1)
        else:
            key, version = rng.randrange(12), rng.randrange(1, 5)
            doc = model.event(key, version)
            kind = rng.random()
            if kind < 0.15:
                doc = bad(key, version, o_comment=f"other {rng.randrange(2)}")
            elif kind < 0.3:
                doc = bad(key, version, o_totalprice=rng.choice([None, "-3.00"]))
            elif kind < 0.35:
                doc = bad(key, version, o_comment="n\0l")
        partition = rng.randrange(3)
        used[partition] += rng.randrange(1, 3)
        documents.append((partition, used[partition], doc))
    return documents


def judged_rows(spark, documents):
    records = [model.record(d, o, p) for p, o, d in documents]
    examined = resolve.examine(model.log(spark, records), load_rules()).cache()
    judged = resolve.judge(examined)
    events = resolve.with_outcome(
        resolve.accepted(judged).select("partition", "offset", "ord", "entity_type", "entity_key",
                                        "entity_version")
    )
    found = {(r["partition"], r["offset"]): r["verdict"] for r in judged.collect()}
    outcomes = {(r["partition"], r["offset"]): r["outcome"] for r in events.collect()}
    return {**found, **outcomes}


@pytest.mark.parametrize("heavy_rows", [10_000, 2])
def test_random_feeds_equal_the_sequential_model(spark, monkeypatch, heavy_rows):
    """With two copies counting as heavy, every path for heavy keys runs."""
    monkeypatch.setattr(skew, "HEAVY_ROWS", heavy_rows)
    monkeypatch.setattr(positions, "_BLOCK_BITS", 20 if heavy_rows > 2 else 3)
    for seed in (1, 2):
        documents = random_feed(seed, 400)
        assert judged_rows(spark, documents) == model.Model().process(documents)


def test_epochs_equal_the_model_and_any_cut_converges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", 3)
    documents = sorted(random_feed(7, 300), key=lambda item: item[:2])
    sums = []
    for number, cuts in enumerate(([300], [100, 300])):
        tables, expected, start = Tables(spark, str(tmp_path / f"t{number}")), model.Model(), 0
        for end in cuts:
            part = documents[start:end]
            records = [model.record(d, o, p) for p, o, d in part]
            found = epoch(spark, tables, records)
            verdicts = list(expected.process(part).values())
            for outcome in ("applied", "stale", "duplicate"):
                assert found.get(outcome, 0) == verdicts.count(outcome)
            assert sum(found.values()) == len(part), "no record is dropped"
            start = end
        state = {(r["entity_type"], r["entity_key"]): (r["entity_version"], r["last_event_id"])
                 for r in tables.current_state().collect()}
        assert state == expected.state
        assert tables.quarantine().count() == len(expected.quarantined)
        sums.append(sums_of(tables))
    assert sums[0] == sums[1]


def test_shuffled_deliveries_converge(spark, tmp_path):
    events = [model.event(k, v) for k in range(5) for v in (1, 2, 3)]
    sums = []
    for seed in (0, 1):
        order = events + random.Random(seed).sample(events, 6)
        random.Random(seed).shuffle(order)
        tables = Tables(spark, str(tmp_path / str(seed)))
        epoch(spark, tables, feed(*order))
        sums.append(sums_of(tables))
    assert sums[0] == sums[1]


def test_a_retried_epoch_replaces_what_it_left(spark, tables, monkeypatch):
    records = feed(model.event(), model.event(1, 2), bad(2, o_totalprice=None))

    def crash(*_args, **_kwargs):
        raise RuntimeError("killed before the commit")

    with monkeypatch.context() as patched:
        patched.setattr(Tables, "commit", crash)
        with pytest.raises(RuntimeError):
            epoch(spark, tables, records)
    assert tables.event_log().count() == 0, "nothing shows before the commit"
    assert epoch(spark, tables, records) == {"applied": 2, "quarantined": 1}
    assert tables.event_log().count() == 2
    resolve_epoch(model.log(spark, records), tables, load_rules(), 0)
    assert tables.event_log().count() == 2, "a committed epoch does not run again"


def test_state_compaction_changes_nothing(spark, tables):
    epoch(spark, tables, feed(model.event(1), model.event(2)))
    epoch(spark, tables, feed(model.event(1, 2), start=5))
    before = sums_of(tables)
    tables.compact_state()
    assert sums_of(tables) == before
    assert epoch(spark, tables, feed(model.event(1, 2), model.event(2, 3), start=9)) == {
        "applied": 1, "duplicate": 1}
    assert tables.current_state().agg(F.sum("entity_version")).first()[0] == 5


def test_two_topics_share_no_sequence_number(spark, tables):
    records = feed(*(model.event(k) for k in range(1, 21)))
    other = [("other", *r[1:]) for r in feed(*(model.event(k) for k in range(11, 31)))]
    assert epoch(spark, tables, [*records, *other]) == {"applied": 30, "duplicate": 10}
    rows = tables.records().select("topic", "log_seq").collect()
    assert len({r["log_seq"] for r in rows}) == len(rows) == 40
    # Topics are taken in their order, so the first one's copies are duplicates.
    assert {r["topic"] for r in tables.records().where("verdict = 'duplicate'").collect()} == {"test"}


def test_an_epoch_opens_the_runs_of_its_own_buckets(spark, tables, monkeypatch):
    epoch(spark, tables, feed(*(model.event(k) for k in range(1, 60))))
    opened = []
    read = type(tables.logged)._read

    def noted(runs, paths):
        listed = list(paths)
        opened.append((runs.root.rsplit("/", 1)[1], len(listed)))
        return read(runs, listed)

    monkeypatch.setattr(type(tables.logged), "_read", noted)
    assert epoch(spark, tables, feed(model.event(5), model.event(5, 2), start=100)) == {"applied": 1, "duplicate": 1}
    assert max(n for name, n in opened if name == "logged") <= 2
    assert max(n for name, n in opened if name == "versions") == 1
    assert not tables.exists(f"{tables.root}/staging")
