from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from changefeed.operators.rules import load_rules
from changefeed.plans import reads
from changefeed.plans.materialize import resolve_epoch
from changefeed.sources import log as log_source
from changefeed.streaming.tables import Tables
from tests import model


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    events = [model.event(k, v) for k in (1, 2) for v in (1, 2, 3)]
    bad = model.event(2, 4, payload=model.payload(2, o_orderstatus="X"))
    other = model.event(1, 1, entity_type="customer", payload={"name": "x"})
    redelivered = model.event(1, 1)
    documents = [*events, bad, other, redelivered, b"garbage"]
    records = [model.record(d, i) for i, d in enumerate(documents)]
    built = Tables(spark, str(tmp_path_factory.mktemp("reads")))
    resolve_epoch(model.log(spark, records), built, load_rules(), 0)
    return built


def test_pages_are_newest_first_and_end(tables):
    seen, token = [], None
    while True:
        page, token = reads.page_with_next(tables.event_log(), "log_seq", limit=3, token=token)
        seen += [r["log_seq"] for r in page.orderBy(F.desc("log_seq")).collect()]
        if token is None:
            break
    assert seen == sorted(seen, reverse=True) and len(seen) == 7
    with pytest.raises(reads.InvalidPage):
        reads.page_with_next(tables.event_log(), "log_seq", limit=3, token="nonsense")


def test_filters(tables):
    log = tables.event_log()

    def versions(**wanted):
        rows = reads.filter_events(log, reads.EventFilters(**wanted)).collect()
        return sorted(r["entity_version"] for r in rows)

    assert versions(entity_key="2") == [1, 2, 3]
    assert versions(event_type="insert", entity_type="order") == [1, 1]
    second = model.T0 + timedelta(hours=1, minutes=14)
    assert versions(occurred_after=second, occurred_before=second + timedelta(seconds=1)) == [2]
    assert versions(occurred_after=second, occurred_before=second + timedelta(hours=1, seconds=1)) == [1, 2, 2, 3]
    with pytest.raises(ValueError):
        reads.EventFilters(occurred_after=second, occurred_before=second)
    wanted = model.event(1, 2)["event_id"]
    assert reads.event_by_id(log, wanted).first()["entity_version"] == 2
    assert reads.event_by_id(log, "absent").isEmpty()


def test_entity_view_joins_state_history_and_rejections(tables):
    view = reads.entity_view(
        tables.current_state(), tables.event_log(), tables.quarantine(), limit=2
    )
    rows = {(r["entity_type"], r["entity_key"]): r for r in view.collect()}
    two = rows[("order", "2")]
    assert two["entity_version"] == 3
    assert [e["entity_version"] for e in two["history"]] == [2, 3]
    assert two["history_truncated"]
    assert [q["reason"] for q in two["quarantined"]] == ["quality_rule_failed"]
    assert not rows[("customer", "1")]["history_truncated"]
    ambiguous = reads.ambiguous_keys(tables.current_state(), tables.event_log()).collect()
    assert {(r["entity_key"], r["entity_type"]) for r in ambiguous} == {
        ("1", "order"), ("1", "customer")}


def test_statistics(tables):
    totals = reads.stats_totals(
        tables.event_log(), tables.current_state(), tables.outcomes()
    ).first()
    assert (totals["events"], totals["entities"], totals["duplicates"]) == (7, 3, 1)
    assert totals["latest_processed"] is not None
    lag = reads.lag_stats(tables.event_log()).first()
    assert lag["sample_size"] == 7
    assert (lag["capture_p50"], lag["capture_max"]) == (200.0, 200.0)
    by_reason = reads.quarantine_by_reason(tables.quarantine()).collect()
    assert {r["reason"]: r["records"] for r in by_reason} == {
        "quality_rule_failed": 1, "schema_violation": 1}
    assert reads.orphan_states(tables.current_state(), tables.event_log()).isEmpty()


def test_history_ranks_before_the_shuffle(tables):
    plan = reads.entity_history(tables.event_log(), limit=2)._jdf.queryExecution()
    assert "WindowGroupLimit" in plan.executedPlan().toString()


def test_kafka_shape_round_trips(spark):
    records = model.log(spark, [model.record(model.event(), 0, headers={"a": "x"})])
    sent = log_source.to_kafka(records).withColumns(
        {"topic": F.lit("t"), "partition": F.lit(0), "offset": F.lit(0).cast("bigint")}
    )
    [row] = log_source.from_kafka(sent).collect()
    assert row["headers"] == {"a": "x"} and bytes(row["key"]) == b"1"


def test_offsets_and_lag(spark, tables):
    records = model.log(
        spark, [model.record(model.event(k), k, partition=k % 2) for k in range(1, 8)]
    )
    ends = log_source.end_offsets(records)
    assert {r["partition"]: r["end_offset"] for r in ends.collect()} == {0: 7, 1: 8}
    committed = ends.where("partition = 0").select(
        "topic", "partition", F.lit(3).cast("bigint").alias("committed_offset")
    )
    lags = {r["partition"]: r["lag"] for r in log_source.consumer_lag(ends, committed).collect()}
    assert lags == {0: 4, 1: 7}
    rest = log_source.bounded(records, ends, committed=committed)
    assert sorted(r["offset"] for r in rest.collect()) == [1, 3, 4, 5, 6, 7]
