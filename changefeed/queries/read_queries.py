"""The read side, over the resolved feed and over the events table as a log."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.plans import reads
from changefeed.queries import query
from changefeed.queries.sql import event_uuid, with_verdicts
from changefeed.queries.tables import sink
from changefeed.sources.orders import table

_LOG = """
log AS (
  SELECT event_id AS log_seq, 'e' || event_id AS event_id, event_type, 'user' AS entity_type,
         CAST(user_id AS VARCHAR) AS entity_key, epoch_us(ts) AS occurred_at,
         epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) AS captured_at,
         epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) + user_id * 1000000 AS processed_at,
         'b' || (event_id // 500) AS batch_id
  FROM events)
"""
_COLUMNS = "log_seq, event_id, event_type, entity_key, occurred_at, batch_id"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in the shape of the event log."""
    at = F.unix_micros("ts")
    captured = at + F.round(F.col("value") * 1_000_000).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("log_seq"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        "event_type",
        F.lit("user").alias("entity_type"),
        F.col("user_id").cast("string").alias("entity_key"),
        F.col("ts").alias("occurred_at"),
        F.timestamp_micros(captured).alias("captured_at"),
        F.timestamp_micros(captured + F.col("user_id") * 1_000_000).alias("processed_at"),
        F.concat(F.lit("b"), F.floor(F.col("event_id") / 500).cast("string")).alias("batch_id"),
    )


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "log_seq", "event_id", "event_type", "entity_key",
        F.unix_micros("occurred_at").alias("occurred_at"), "batch_id",
    )


@query(
    "events_filter",
    f"WITH {_LOG} SELECT {_COLUMNS} FROM log WHERE event_type = 'click' AND entity_type = 'user' "
    "AND entity_key = '8'",
)
def events_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = reads.EventFilters(event_type="click", entity_type="user", entity_key="8")
    return _shown(reads.filter_events(_log(spark, sf_dir), wanted))


@query("events_by_batch", f"WITH {_LOG} SELECT {_COLUMNS} FROM log WHERE batch_id = 'b1'")
def events_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = reads.EventFilters(batch_id="b1")
    return _shown(reads.filter_events(_log(spark, sf_dir), wanted))


@query(
    "events_window",
    f"WITH {_LOG} SELECT {_COLUMNS} FROM log WHERE occurred_at >= epoch_us(TIMESTAMP '2024-01-05') "
    "AND occurred_at < epoch_us(TIMESTAMP '2024-01-09')",
)
def events_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = reads.EventFilters(
        occurred_after=datetime(2024, 1, 5, tzinfo=UTC),
        occurred_before=datetime(2024, 1, 9, tzinfo=UTC),
    )
    return _shown(reads.filter_events(_log(spark, sf_dir), wanted))


@query(
    "events_page",
    f"WITH {_LOG} SELECT {_COLUMNS} FROM log WHERE event_type = 'click' AND log_seq < 900 "
    "ORDER BY log_seq DESC LIMIT 51",
)
def events_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads.filter_events(_log(spark, sf_dir), reads.EventFilters(event_type="click"))
    return _shown(reads.page(rows, "log_seq", limit=50, before=900))


@query("event_by_id", f"WITH {_LOG} SELECT {_COLUMNS} FROM log WHERE event_id = 'e77'")
def event_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reads.event_by_id(_log(spark, sf_dir), "e77"))


@query("latest_event", f"WITH {_LOG} SELECT {_COLUMNS} FROM log ORDER BY log_seq DESC LIMIT 1")
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reads.latest_event(_log(spark, sf_dir)))


def _lag_sql() -> str:
    legs = {
        "end_to_end": "(processed_at - occurred_at) / 1e6",
        "capture": "(captured_at - occurred_at) / 1e6",
        "delivery": "(processed_at - captured_at) / 1e6",
    }
    figures = ", ".join(
        f"round(avg({x}),3) AS {n}_avg, round(quantile_cont({x},0.5),3) AS {n}_p50, "
        f"round(quantile_cont({x},0.95),3) AS {n}_p95, round(max({x}),3) AS {n}_max"
        for n, x in ((name, name) for name in legs)
    )
    columns = ", ".join(f"CAST({x} AS DOUBLE) AS {n}" for n, x in legs.items())
    return (
        f"WITH {_LOG}, recent AS (SELECT {columns} FROM log) "
        f"SELECT count(*) AS sample_size, {figures} FROM recent"
    )


@query("lag_stats", _lag_sql())
def lag_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.lag_stats(_log(spark, sf_dir))


@query(
    "record_lag",
    f"WITH {_LOG} SELECT event_id, processed_at - occurred_at AS lag_micros FROM log",
)
def record_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads.record_lag(_log(spark, sf_dir))
    return rows.select(
        "event_id", F.round(F.col("lag_seconds") * 1_000_000).cast("bigint").alias("lag_micros")
    )


@query(
    "events_by_type",
    with_verdicts("SELECT event_type, count(*) AS events FROM accepted GROUP BY event_type"),
)
def events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.events_by_type(sink(spark, sf_dir).event_log())


@query(
    "quarantine_by_reason",
    with_verdicts("SELECT reason, count(*) AS records FROM quarantined GROUP BY reason"),
)
def quarantine_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.quarantine_by_reason(sink(spark, sf_dir).quarantine())


@query(
    "stats_totals",
    with_verdicts(
        "SELECT (SELECT count(*) FROM accepted) AS events, "
        "(SELECT count(*) FROM accepted WHERE len(warns) > 0) AS warned, "
        "(SELECT epoch_us(max(occurred)) FROM accepted) AS latest_occurred, "
        "(SELECT count(*) FROM state) AS entities, "
        "(SELECT count(*) FROM verdicts WHERE verdict = 'duplicate') AS duplicates"
    ),
)
def stats_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = sink(spark, sf_dir)
    totals = reads.stats_totals(tables.event_log(), tables.current_state(), tables.outcomes())
    return totals.drop("latest_processed").withColumn(
        "latest_occurred", F.unix_micros("latest_occurred")
    )


@query(
    "state_by_key",
    with_verdicts(
        "SELECT entity_type, entity_key, version AS entity_version, payload FROM state "
        "WHERE entity_type = 'order' AND entity_key = '97'"
    ),
)
def state_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reads.state_by_key(sink(spark, sf_dir).current_state(), "order", "97")
    return found.select("entity_type", "entity_key", "entity_version", "payload")


_QUARANTINE = "quarantine_seq, quarantine_id, reason, entity_key"


@query(
    "quarantine_filter",
    with_verdicts(f"SELECT {_QUARANTINE} FROM quarantined WHERE reason = 'event_id_conflict'"),
)
def quarantine_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sink(spark, sf_dir).quarantine()
    found = reads.filter_quarantine(rows, reason="event_id_conflict")
    return found.select(*_QUARANTINE.split(", "))


@query(
    "quarantine_page",
    with_verdicts(
        f"SELECT {_QUARANTINE} FROM quarantined ORDER BY quarantine_seq DESC LIMIT 51"
    ),
)
def quarantine_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reads.page(sink(spark, sf_dir).quarantine(), "quarantine_seq", limit=50)
    return found.select(*_QUARANTINE.split(", "))


@query(
    "entity_types",
    with_verdicts(
        "SELECT entity_type, entity_key FROM state UNION SELECT entity_type, entity_key FROM accepted"
    ),
)
def entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = sink(spark, sf_dir)
    return reads.entity_types(tables.current_state(), tables.event_log())


@query(
    "ambiguous_keys",
    with_verdicts(
        ", t AS (SELECT DISTINCT entity_type, entity_key FROM accepted) "
        "SELECT entity_key, entity_type, count(*) OVER (PARTITION BY entity_key) AS types FROM t "
        "QUALIFY types > 1"
    ),
)
def ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = sink(spark, sf_dir)
    return reads.ambiguous_keys(tables.current_state(), tables.event_log())


@query(
    "entity_history",
    f"""WITH {_LOG}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY entity_type, entity_key ORDER BY log_seq DESC) AS n,
         count(*) OVER (PARTITION BY entity_type, entity_key) AS c FROM log)
SELECT entity_type, entity_key, log_seq, event_type, c > 10 AS truncated FROM ranked WHERE n <= 10""",
)
def entity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reads.entity_history(_log(spark, sf_dir), limit=10)
    return found.select("entity_type", "entity_key", "log_seq", "event_type", "truncated")


@query(
    "entity_view",
    with_verdicts(
        """, h AS (SELECT *, row_number() OVER (PARTITION BY entity_type, entity_key ORDER BY seq DESC) AS n,
                      count(*) OVER (PARTITION BY entity_type, entity_key) AS c FROM accepted),
hist AS (SELECT entity_type, entity_key, string_agg(CAST(version AS VARCHAR), ',' ORDER BY seq) AS history,
                max(c) > 2 AS history_truncated FROM h WHERE n <= 2 GROUP BY ALL),
qr AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY quarantine_seq DESC) AS n FROM quarantined),
rej AS (SELECT entity_key, string_agg(reason, ',' ORDER BY quarantine_seq DESC) AS quarantined
        FROM qr WHERE n <= 2 GROUP BY entity_key)
SELECT hist.entity_type, coalesce(hist.entity_key, rej.entity_key) AS entity_key, s.version AS current_version, history, history_truncated, quarantined
FROM hist JOIN state s ON s.entity_type = hist.entity_type AND s.entity_key = hist.entity_key
FULL OUTER JOIN rej ON rej.entity_key = hist.entity_key"""
    ),
)
def entity_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = sink(spark, sf_dir)
    view = reads.entity_view(
        tables.current_state(), tables.event_log(), tables.quarantine(), limit=2
    )
    versions = F.transform("history", lambda e: e["entity_version"].cast("string"))
    return view.select(
        "entity_type", "entity_key", F.col("entity_version").alias("current_version"),
        F.array_join(versions, ",").alias("history"), "history_truncated",
        F.array_join(F.transform("quarantined", lambda q: q["reason"]), ",").alias("quarantined"),
    )
