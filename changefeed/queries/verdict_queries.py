"""What becomes of the records: verdicts, outcomes, the tables and their checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.operators import resolve
from changefeed.operators.rules import RuleSet, load_rules, parse_rules, with_severity
from changefeed.plans import reads
from changefeed.plans.materialize import resolve_epoch
from changefeed.plans.replay import converged, rejudge, replay, state_differences
from changefeed.queries import query
from changefeed.queries.sql import with_records, with_verdicts
from changefeed.queries.tables import examined, sink
from changefeed.schemas import ENVELOPE_FIELDS
from changefeed.session import shared_dir, stage
from changefeed.sources.feed import change_log
from changefeed.streaming.tables import Generations

_REQUIRED = "[" + ",".join(f"'{name}'" for name in ENVELOPE_FIELDS) + "]"


@query(
    "schema_violations",
    with_records("")
    + f""", docs AS (
  SELECT part, off, bad_kind, event_id,
    CASE bad_kind
      WHEN 0 THEN encode('{{"event_id": "not closed')
      WHEN 1 THEN encode('{{"schema_version":1,"event_type":"' || event_type || '"}}')
      WHEN 4 THEN NULL WHEN 5 THEN unhex('FFFE7B7D')
      ELSE encode('{{"schema_version":' || CASE bad_kind WHEN 2 THEN 2 ELSE 1 END || ',"event_id":"'
        || CASE bad_kind WHEN 3 THEN 'other' ELSE event_id END || '","event_type":"x","source":{{}},"entity_type":"x",'
        || '"entity_key":"x","entity_version":1,"occurred_at":"x","captured_at":"x","batch_id":"x","payload":{{}}}}') END AS value
  FROM records WHERE bad_kind IS NOT NULL),
texts AS (SELECT *, try(decode(value)) AS doc FROM docs),
found AS (
  SELECT part, off, CASE
    WHEN value IS NULL THEN ['missing_value:']
    WHEN doc IS NULL OR NOT json_valid(doc) THEN ['json_invalid:']
    WHEN len(json_keys(doc)) < 11 THEN list_transform(
      list_filter({_REQUIRED}, lambda f: NOT list_contains(json_keys(doc), f)), lambda f: 'missing:' || f)
    WHEN json_extract_string(doc, '$.schema_version') <> '1' THEN ['literal_error:schema_version']
    WHEN json_extract_string(doc, '$.event_id') <> event_id THEN ['value_error:'] END AS errors
  FROM texts)
SELECT part AS partition, off AS offset, array_to_string(list_sort(errors), ',') AS errors FROM found""",
)
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = examined(spark, sf_dir).where(~F.col("is_event"))
    named = F.transform("errors", lambda e: F.concat(e["type"], F.lit(":"), e["loc"]))
    return broken.select(
        "partition", "offset", F.array_join(F.array_sort(named), ",").alias("errors")
    )


@query(
    "decoded_events",
    with_records(
        "SELECT part AS partition, off AS offset, event_id, event_type, object, entity_type, entity_key, "
        "version AS entity_version, epoch_us(occurred) AS occurred_at, epoch_us(captured) AS captured_at, "
        "batch_id, payload, fp AS fingerprint FROM prints WHERE bad_kind IS NULL"
    ),
)
def decoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every readable record with its canonical payload and fingerprint."""
    events = examined(spark, sf_dir).where("is_event")
    return events.select(
        "partition", "offset", "event_id", "event_type", F.col("source.object").alias("object"),
        "entity_type", "entity_key", "entity_version",
        F.unix_micros("occurred_at").alias("occurred_at"),
        F.unix_micros("captured_at").alias("captured_at"),
        "batch_id", "payload", "fingerprint",
    )


@query(
    "non_derived_ids",
    with_records("SELECT part AS partition, off AS offset, entity_key FROM records WHERE bad_kind = 3"),
)
def non_derived_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = examined(spark, sf_dir)
    wrong = F.array_contains(F.col("errors.type"), "value_error")
    return rows.where(wrong).select("partition", "offset", "entity_key")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.judge(examined(spark, sf_dir))


@query(
    "dedup_outcomes",
    with_verdicts("SELECT part AS partition, off AS offset, verdict FROM verdicts"),
)
def dedup_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("partition", "offset", "verdict")


@query(
    "apply_outcomes",
    with_verdicts(
        "SELECT part AS partition, off AS offset, entity_type, entity_key, "
        "version AS entity_version, outcome FROM outcomes"
    ),
)
def apply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = resolve.accepted(_judged(spark, sf_dir)).select(
        "partition", "offset", "ord", "entity_type", "entity_key", "entity_version"
    )
    return resolve.with_outcome(narrow).drop("ord")


@query(
    "outcome_counts",
    with_verdicts(
        "SELECT outcome, count(*) AS records FROM (SELECT outcome FROM outcomes UNION ALL "
        "SELECT CASE verdict WHEN 'duplicate' THEN 'duplicate' ELSE 'quarantined' END "
        "FROM verdicts WHERE verdict <> 'accepted') GROUP BY outcome"
    ),
)
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sink(spark, sf_dir).outcomes()


@query(
    "id_conflicts",
    with_verdicts(
        "SELECT part AS partition, off AS offset, event_id, logged_fp AS logged_fingerprint, "
        "fp AS incoming_fingerprint FROM verdicts WHERE verdict = 'event_id_conflict'"
    ),
)
def id_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _judged(spark, sf_dir).where(F.col("verdict") == "event_id_conflict")
    return rows.select(
        "partition", "offset", "event_id", "logged_fingerprint",
        F.col("fingerprint").alias("incoming_fingerprint"),
    )


@query(
    "sink_rejected",
    with_verdicts(
        "SELECT part AS partition, off AS offset, event_id FROM verdicts WHERE verdict = 'sink_rejected'"
    ),
)
def sink_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _judged(spark, sf_dir).where(F.col("verdict") == "sink_rejected")
    return rows.select("partition", "offset", "event_id")


@query(
    "quality_routing",
    with_verdicts(
        "SELECT part AS partition, off AS offset, verdict, array_to_string(rejects, ',') AS rejected_by, "
        "array_to_string(warns, ',') AS warned_by FROM verdicts "
        "WHERE bad_kind IS NULL AND (len(rejects) > 0 OR len(warns) > 0)"
    ),
)
def quality_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _judged(spark, sf_dir).where(F.size("violations") > 0)

    def named(severity: str) -> F.Column:
        chosen = with_severity(F.col("violations"), severity)
        return F.array_join(F.transform(chosen, lambda v: v["rule"]), ",")

    return rows.select(
        "partition", "offset", "verdict", named("reject").alias("rejected_by"),
        named("warn").alias("warned_by"),
    )


@query(
    "known_fingerprints",
    with_verdicts(
        "SELECT DISTINCT a.event_id, a.fp AS fingerprint FROM accepted a "
        "JOIN records r ON r.event_id = a.event_id WHERE r.bad_kind IS NULL AND r.off % 16 < 8"
    ),
)
def known_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logged ids of a later batch: every other block of eight offsets again."""
    batch = examined(spark, sf_dir).where(F.col("is_event") & (F.col("offset") % 16 < 8))
    return resolve.known_fingerprints(batch, sink(spark, sf_dir).logged_fingerprints())


@query(
    "event_log",
    with_verdicts(
        "SELECT seq AS log_seq, event_id, event_type, 1 AS schema_version, entity_type, entity_key, "
        "version AS entity_version, payload, epoch_us(occurred) AS occurred_at, "
        "epoch_us(captured) AS captured_at, batch_id, fp AS fingerprint, "
        "array_to_string(warns, ',') AS warnings, 'changes' AS topic, part AS partition, "
        "off AS offset FROM accepted"
    ),
)
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sink(spark, sf_dir).event_log()
    warnings = F.array_join(F.transform("quality_warnings", lambda v: v["rule"]), ",")
    return rows.select(
        "log_seq", "event_id", "event_type", "schema_version", "entity_type", "entity_key",
        "entity_version", "payload", F.unix_micros("occurred_at").alias("occurred_at"),
        F.unix_micros("captured_at").alias("captured_at"), "batch_id", "fingerprint",
        warnings.alias("warnings"), "topic", "partition", "offset",
    )


_STATE = (
    "SELECT entity_type, entity_key, version AS entity_version, payload, event_id AS last_event_id, "
    "event_type AS last_event_type, epoch_us(occurred) AS occurred_at FROM state"
)


@query("current_state", with_verdicts(_STATE))
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sink(spark, sf_dir).current_state()
    return rows.drop("source", "updated_at").withColumn("occurred_at", F.unix_micros("occurred_at"))


@query("state_after_epochs", with_verdicts(_STATE))
def state_after_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state after four epochs by offset, each with its lookups in the runs of the others."""
    root = f"{shared_dir(spark)}/changefeed/epochs-{uuid.uuid4().hex}"
    log = stage(change_log(spark, sf_dir), "log", path=f"{root}/log")
    tables = Generations(spark, root).current()
    step = log.agg(F.floor(F.max("offset") / 4) + 1).first()[0]
    for epoch in range(4):
        part = log.where((F.col("offset") >= epoch * step) & (F.col("offset") < (epoch + 1) * step))
        resolve_epoch(part, tables, load_rules(), epoch)
    newest = tables.versions.rows(3).groupBy("entity_type", "entity_key").agg(
        F.max("entity_version").alias("entity_version")
    )
    # The runs know the version of every entity, or this has fewer rows than the SQL.
    rows = tables.current_state().join(newest, newest.columns)
    return rows.drop("source", "updated_at").withColumn("occurred_at", F.unix_micros("occurred_at"))


@query("rejudged_state", with_verdicts(_STATE))
def rejudged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state when a stricter rule set held back the orders of many customers first."""
    bound = {
        "name": "customer_below_bound", "description": "Customers up to a bound.", "check": "max",
        "value": 50, "field": "o_custkey", "severity": "reject",
    }
    shipped, extra = load_rules(), parse_rules({"version": 1, "entities": {"order": [bound]}})
    strict = RuleSet({**shipped.entities, "order": shipped.entities["order"] + extra.entities["order"]})
    tables = Generations(spark, f"{shared_dir(spark)}/changefeed/rejudged-{uuid.uuid4().hex}").current()
    resolve_epoch(change_log(spark, sf_dir), tables, strict)
    rejudge(tables, shipped)
    rows = tables.current_state()
    return rows.drop("source", "updated_at").withColumn("occurred_at", F.unix_micros("occurred_at"))


@query(
    "merged_state",
    with_verdicts(_STATE),
)
def merged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state, reached by merging the events of odd offsets into those of even ones."""
    events = resolve.accepted(_judged(spark, sf_dir))
    even = events.where(F.col("offset") % 2 == 0)
    odd = events.where(F.col("offset") % 2 == 1)
    now = F.current_timestamp()
    merged = resolve.merge_state(
        resolve.best_versions(even, now), resolve.best_versions(odd, now)
    )
    return merged.drop("source", "updated_at").withColumn(
        "occurred_at", F.unix_micros("occurred_at")
    )


@query(
    "quarantine",
    with_verdicts(
        "SELECT quarantine_id, quarantine_seq, reason, event_id, entity_type, entity_key, batch_id, "
        "'changes' AS topic, part AS partition, off AS offset FROM quarantined"
    ),
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sink(spark, sf_dir).quarantine()
    return rows.select(
        "quarantine_id", "quarantine_seq", "reason", "event_id", "entity_type", "entity_key",
        "batch_id", "topic", "partition", "offset",
    )


@query(
    "violations_by_rule",
    with_verdicts(
        "SELECT rule, severity, count(*) AS records FROM ("
        "SELECT unnest(rejects) AS rule, 'reject' AS severity FROM quarantined WHERE reason = 'quality_rule_failed' "
        "UNION ALL SELECT unnest(warns), 'warn' FROM quarantined WHERE reason = 'quality_rule_failed') "
        "GROUP BY ALL"
    ),
)
def violations_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.violations_by_rule(sink(spark, sf_dir).quarantine())


def _sum_sql(rows: str, text: str, prefix: str) -> str:
    def part(start: int) -> str:
        return f"CAST(coalesce(sum(('0x' || substr(md5({text}),{start},15))::BIGINT), 0) AS VARCHAR)"

    return (
        f"SELECT count(*) AS {prefix}_rows, md5({part(1)} || '|' || {part(16)}) AS {prefix}_checksum "
        f"FROM {rows}"
    )


_STATE_TEXT = "concat_ws('|', entity_type, entity_key, version, payload, event_id)"
_STATE_SUM = _sum_sql("state", _STATE_TEXT, "state")
_LOG_SUM = _sum_sql("accepted", "concat_ws('|', event_id, fp)", "log")
_QUARANTINE_SUM = _sum_sql("quarantined", "quarantine_id", "quarantine")


@query("checksum_state", with_verdicts(_STATE_SUM))
def checksum_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sink(spark, sf_dir).current_state()
    return reads.checksum(rows, reads.STATE_CONTENT, prefix="state")


@query("checksum_log", with_verdicts(_LOG_SUM))
def checksum_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.checksum(sink(spark, sf_dir).event_log(), reads.LOG_CONTENT, prefix="log")


@query("checksum_quarantine", with_verdicts(_QUARANTINE_SUM))
def checksum_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sink(spark, sf_dir).quarantine()
    return reads.checksum(rows, reads.QUARANTINE_CONTENT, prefix="quarantine")


@query(
    "replay_converges",
    with_verdicts(
        f"SELECT 'rebuild' AS mode, (SELECT count(*) FROM verdicts) AS records_replayed, TRUE AS converged, "
        f"s.*, l.*, q.* FROM ({_STATE_SUM}) s, ({_LOG_SUM}) l, ({_QUARANTINE_SUM}) q"
    ),
)
def replay_converges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two epochs by offset, then a rebuild of the whole log in one."""
    root = f"{shared_dir(spark)}/changefeed/replay-{uuid.uuid4().hex}"
    log = stage(change_log(spark, sf_dir), "log", path=f"{root}/log")
    rules, generations = load_rules(), Generations(spark, root)
    bound = log.agg(F.floor(F.max("offset") / 2)).first()[0]
    resolve_epoch(log.where(F.col("offset") <= bound), generations.current(), rules, 0)
    same = converged(replay(log, generations, rules, rebuild=True))
    tables = generations.current()
    outcomes = tables.epoch_outcomes(tables.last_commit().epoch)
    sums = reads.table_checksums(tables.current_state(), tables.event_log(), tables.quarantine())
    return sums.select(
        F.lit("rebuild").alias("mode"),
        F.lit(outcomes.agg(F.sum("records")).first()[0]).cast("bigint").alias("records_replayed"),
        F.lit(same).alias("converged"),
        "*",
    )


@query(
    "replay_diff",
    with_verdicts(
        """SELECT f.entity_type, f.entity_key, h.version AS version_before, f.version AS version_after
FROM state f LEFT JOIN (
  SELECT entity_type, entity_key, max(version) AS version FROM accepted WHERE off % 16 < 8 GROUP BY ALL) h
ON f.entity_type = h.entity_type AND f.entity_key = h.entity_key WHERE h.version IS DISTINCT FROM f.version"""
    ),
)
def replay_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a part of the log against the state of all of it."""
    events = sink(spark, sf_dir).records().where("verdict = 'accepted'")
    now = F.current_timestamp()
    part = resolve.best_versions(events.where(F.col("offset") % 16 < 8), now)
    differing = state_differences(part, resolve.best_versions(events, now))
    return differing.select(
        "entity_type", "entity_key",
        F.col("before.entity_version").alias("version_before"),
        F.col("after.entity_version").alias("version_after"),
    )


@query("orphan_states", with_verdicts("SELECT event_id AS last_event_id FROM state WHERE version > 2"))
def orphan_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States whose event a log cut at version 2 does not hold."""
    tables = sink(spark, sf_dir)
    cut = tables.event_log().where(F.col("entity_version") <= 2)
    return reads.orphan_states(tables.current_state(), cut).select("last_event_id")
