from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changefeed.operators.envelope import SourceSpec
from changefeed.operators.rules import load_rules
from changefeed.plans import capture as capture_plan
from changefeed.plans.capture import Capture
from changefeed.plans.replay import converged, replay
from changefeed.sources import changes
from changefeed.sources.changes import Position
from changefeed.sources.log import stream_log
from changefeed.sources.orders import seed_if_empty
from changefeed.streaming.ledger import LedgerError
from changefeed.streaming.stream import materialize_stream
from changefeed.streaming.tables import Generations

T0 = datetime(2026, 1, 1, 12, tzinfo=UTC)
SPEC = SourceSpec("parquet", "orders", "order", "o_orderkey", "row_version", "updated_at")
DDL = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(12,2),"
    " o_orderdate date, o_comment string, row_version bigint, updated_at timestamp"
)


def source(spark, rows):
    """Rows as (key, version, time) or with changed business values."""
    values = []
    for key, version, at, *more in rows:
        change = more[0] if more else {}
        price = change.get("price", "10.50")
        values.append((key, change.get("status", "O"), price, f"order {key}", version,
                       int(at.timestamp() * 1_000_000)))
    df = spark.createDataFrame(
        values, "k bigint, s string, p string, c string, v bigint, us bigint"
    )
    return df.select(
        F.col("k").alias("o_orderkey"), F.lit(7).cast("bigint").alias("o_custkey"),
        F.col("s").alias("o_orderstatus"), F.col("p").cast("decimal(12,2)").alias("o_totalprice"),
        F.to_date(F.lit("1996-03-01")).alias("o_orderdate"), F.col("c").alias("o_comment"),
        F.col("v").alias("row_version"), F.timestamp_micros("us").alias("updated_at"),
    )


def make(spark, tmp_path, **options):
    settings = {"batch_size": 3, "settle_seconds": 0, **options}
    return Capture(spark, str(tmp_path / "capture"), SPEC, **settings)


BULK = [(key, 1, T0) for key in range(1, 8)]


def keys(capture):
    return sorted(int(bytes(r["key"]).decode()) for r in capture.log().collect())


def test_tied_times_are_cut_into_batches_and_a_rerun_emits_nothing(spark, tmp_path):
    capture = make(spark, tmp_path)
    later = T0 + timedelta(hours=1)
    result = capture.run_cycle(source(spark, BULK), as_of=later)
    assert (result.mode, result.batches, result.rows, result.caught_up) == ("full", 3, 7, True)
    assert keys(capture) == list(range(1, 8))
    state = capture.ledger.load(SPEC.source_id, integer_key=True)
    assert state.cursor == Position(T0, 7) and state.mode == "incremental"
    again = capture.run_cycle(source(spark, BULK), as_of=later)
    assert (again.mode, again.rows) == ("incremental", 0)

    changed = [r for r in BULK if r[0] != 3] + [(3, 2, later), (99, 1, later)]
    assert capture.run_cycle(source(spark, changed), as_of=later).rows == 2
    rows = capture.log().where(F.element_at("headers", "event_type") == "update").collect()
    assert [bytes(r["key"]) for r in rows] == [b"3"]
    log = capture.log().select("partition", "offset").collect()
    assert len({tuple(r) for r in log}) == 9
    for partition in {r["partition"] for r in log}:
        offsets = sorted(r["offset"] for r in log if r["partition"] == partition)
        assert offsets == list(range(len(offsets))), "no gaps in a partition"


def test_a_failed_publish_keeps_the_watermark_and_repeats_the_ids(spark, tmp_path):
    def half_way(records, path):
        records.where(F.col("partition") < 3).write.parquet(path)
        raise OSError("broker unreachable")

    rows = source(spark, BULK)
    with pytest.raises(OSError):
        make(spark, tmp_path, publish=half_way).run_cycle(rows, as_of=T0)
    capture = make(spark, tmp_path)
    assert capture.ledger.load(SPEC.source_id, integer_key=True).cursor is None
    statuses = {r["status"] for r in capture.ledger.batches().collect()}
    assert statuses == {"failed"}
    delivered = capture.log().count()
    assert capture.run_cycle(rows, as_of=T0).rows == 7
    ids = [r["headers"]["event_id"] for r in capture.log().collect()]
    assert len(ids) == 7 + delivered and len(set(ids)) == 7


def test_a_crash_leaves_running_batches_that_the_next_start_closes(spark, tmp_path, monkeypatch):
    capture = make(spark, tmp_path)
    with monkeypatch.context() as patched:
        patched.setattr(capture.ledger, "commit", lambda *a, **k: (_ for _ in ()).throw(SystemExit))
        with pytest.raises(SystemExit):
            capture.run_cycle(source(spark, BULK), as_of=T0)
    assert {r["status"] for r in capture.ledger.batches().collect()} == {"running"}
    make(spark, tmp_path).run_cycle(source(spark, BULK), as_of=T0)
    rows = capture.ledger.batches().orderBy("cycle", "batch_no").collect()
    assert [r["status"] for r in rows] == ["failed"] * 3 + ["committed"] * 3
    assert "without an end" in rows[0]["error"]
    with pytest.raises(LedgerError):
        capture.ledger.commit(1, SPEC.source_id, cursor=Position(T0, 1), rows=1, batches=1,
                              last_batch_id="x", caught_up=True)


def test_rows_inside_the_settle_window_wait(spark, tmp_path):
    capture = make(spark, tmp_path, settle_seconds=10)
    rows = [*BULK, (50, 1, T0 + timedelta(seconds=55))]
    assert capture.run_cycle(source(spark, rows), as_of=T0 + timedelta(seconds=60)).rows == 7
    assert capture.run_cycle(source(spark, rows), as_of=T0 + timedelta(seconds=64)).rows == 0
    assert capture.run_cycle(source(spark, rows), as_of=T0 + timedelta(seconds=65)).rows == 1


def test_stopping_between_batches_resumes_inside_a_tie(spark, tmp_path):
    capture = make(spark, tmp_path)
    first = capture.run_cycle(source(spark, BULK), as_of=T0, max_batches=1)
    assert (first.batches, first.rows, first.caught_up) == (1, 3, False)
    state = capture.ledger.load(SPEC.source_id, integer_key=True)
    assert state.cursor == Position(T0, 3) and state.mode == "full"
    assert capture.run_cycle(source(spark, BULK), as_of=T0).rows == 4
    assert keys(capture) == list(range(1, 8))


def test_an_empty_source_completes_the_initial_sync(spark, tmp_path):
    capture = make(spark, tmp_path)
    result = capture.run_cycle(source(spark, BULK).limit(0), as_of=T0)
    assert (result.rows, result.caught_up) == (0, True)
    assert capture.ledger.load(SPEC.source_id, integer_key=True).mode == "incremental"


def test_contract_and_order_violations_stop_the_cycle(spark, tmp_path):
    capture = make(spark, tmp_path)
    with pytest.raises(changes.ContractError, match="bad_versions"):
        capture.run_cycle(source(spark, [(1, 0, T0)]), as_of=T0)
    with pytest.raises(changes.ContractError, match="share one"):
        capture.run_cycle(source(spark, [(1, 1, T0), (1, 2, T0)]), as_of=T0)
    with pytest.raises(changes.ContractError, match="timestamp"):
        capture.run_cycle(source(spark, BULK).withColumn("updated_at", F.lit("x")), as_of=T0)
    assert capture.log().count() == 0


@pytest.mark.parametrize("key", ["7", True, 7.0])
def test_a_position_of_another_type_is_refused(spark, key):
    with pytest.raises(changes.ContractError, match="o_orderkey is bigint"):
        changes.changed_since(source(spark, BULK), SPEC, Position(T0, key), F.lit(T0))


def test_string_keys(spark, tmp_path):
    rows = source(spark, BULK).withColumn(
        "o_orderkey", F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"))
    )
    capture = make(spark, tmp_path)
    assert capture.run_cycle(rows, as_of=T0).rows == 7
    assert capture.ledger.load(SPEC.source_id, integer_key=False).cursor == Position(T0, "ORD-7")
    assert capture.run_cycle(rows, as_of=T0).rows == 0


def test_pages_over_tied_rows_partition_the_table(spark):
    rows = source(spark, [(key, 1, T0) for key in range(1, 26)])
    cursor, seen = None, []
    while True:
        page = changes.fetch_changes(rows, SPEC, cursor, F.lit(T0), 6).collect()
        if not page:
            break
        seen += [r["o_orderkey"] for r in page]
        cursor = Position(T0, page[-1]["o_orderkey"])
    assert seen == list(range(1, 26))


def test_pushed_filters_and_top_k(spark, tmp_path):
    source(spark, BULK).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    page = changes.fetch_changes(rows, SPEC, Position(T0, 3), F.lit(T0), 2)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(updated_at), LessThanOrEqual(updated_at" in plan
    assert "GreaterThanOrEqual(updated_at" in plan and "TakeOrderedAndProject" in plan


def test_seed_only_if_empty(spark, tmp_path):
    path = str(tmp_path / "seed")
    assert seed_if_empty(source(spark, BULK), path)
    assert not seed_if_empty(source(spark, BULK[:2]), path)
    assert spark.read.parquet(path).count() == 7
    assert seed_if_empty(source(spark, BULK[:2]), path, force=True)
    assert spark.read.parquet(path).count() == 2


def test_end_to_end_numbers(spark, tmp_path):
    """300 rows, then 5 inserts, 7 updates and 3 invalid rows, then a rebuild."""
    capture = make(spark, tmp_path, batch_size=100)
    rules, generations = load_rules(), Generations(spark, str(tmp_path / "sink"))
    base = [(key, 1, T0) for key in range(1, 301)]

    def consume():
        stream = stream_log(spark, f"{capture.log_path}/*", files_per_batch=4)
        query = materialize_stream(
            stream, generations.current(), rules, checkpoint=str(tmp_path / "checkpoint")
        )
        query.awaitTermination()
        return {r["outcome"]: r["records"] for r in generations.current().outcomes().collect()}

    assert capture.run_cycle(source(spark, base), as_of=T0).batches == 3
    assert consume() == {"applied": 300}
    assert capture.run_cycle(source(spark, base), as_of=T0).rows == 0
    assert consume() == {"applied": 300}

    later = T0 + timedelta(hours=1)
    changed = [r for r in base if r[0] > 8]
    changed += [(key, 2, later) for key in range(1, 8)]
    changed += [(key, 1, later) for key in range(301, 306)]
    changed += [(8, 2, later, {"status": "X"}), (306, 1, later, {"price": "-42.00"}),
                (307, 1, later, {"price": None})]
    assert capture.run_cycle(source(spark, changed), as_of=later).rows == 15
    assert consume() == {"applied": 312, "quarantined": 3}
    tables = generations.current()
    assert tables.current_state().count() == 305
    assert {r["reason"] for r in tables.quarantine().collect()} == {"quality_rule_failed"}

    def outcomes():
        now = generations.current()
        return {r["outcome"]: r["records"] for r in now.epoch_outcomes(now.last_commit().epoch).collect()}

    assert converged(replay(capture.log(), generations, rules))
    assert outcomes() == {"duplicate": 312, "quarantined": 3}
    assert converged(replay(capture.log(), generations, rules, rebuild=True))
    assert outcomes() == {"applied": 312, "quarantined": 3}
    assert generations.current().root != tables.root


@pytest.mark.parametrize("rebuild", [False, True])
def test_stream_goes_on_after_a_replay(spark, tmp_path, rebuild):
    capture = make(spark, tmp_path, batch_size=4)
    rules, generations = load_rules(), Generations(spark, str(tmp_path / "sink"))

    def consume():
        log = stream_log(spark, f"{capture.log_path}/*", files_per_batch=1)
        checkpoint = str(tmp_path / "checkpoint")
        materialize_stream(log, generations.current(), rules, checkpoint=checkpoint).awaitTermination()
        return generations.current().event_log().count()

    rows = [(key, 1, T0) for key in range(1, 4)]
    capture.run_cycle(source(spark, rows), as_of=T0)
    assert consume() == 3
    assert converged(replay(capture.log(), generations, rules, rebuild=rebuild))
    later = T0 + timedelta(hours=1)
    rows += [(key, 1, later) for key in range(4, 9)]
    capture.run_cycle(source(spark, rows), as_of=later)
    assert consume() == 8
    assert generations.current().current_state().count() == 8
    assert consume() == 8


def test_batch_numbers():
    assert capture_plan.BATCH_SIZE == 2_000
