"""Verdicts over a set of log records: accepted, duplicate or quarantined.

The order of checks decides: schema, then known id, then rules, then whether the
values can be stored. So a known id is a duplicate or a conflict even if its
content breaks a rule, and an id whose earlier records were all rejected is new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.functions import ids
from changefeed.functions.text import readable
from changefeed.operators.positions import log_order, order_block
from changefeed.operators.rules import RuleSet, with_severity
from changefeed.operators.skew import attach_summary, max_before
from changefeed.operators.validate import decode
from changefeed.schemas import (
    ACCEPTED,
    APPLIED,
    DUPLICATE,
    EVENT_ID_CONFLICT,
    QUALITY_RULE_FAILED,
    QUARANTINE_REASONS,
    QUARANTINED,
    SCHEMA_VIOLATION,
    SINK_REJECTED,
    STALE,
)

# The stored text types refuse NUL, which JSON can carry as an escape.
NUL_ESCAPE = "\\u0000"
UNSTORABLE = "unsupported Unicode escape sequence"


def examine(records: DataFrame, rules: RuleSet) -> DataFrame:
    """Decode the records and run the rules: all that a record tells by itself."""
    evaluated = rules.evaluate(decode(records))
    is_event = F.size("errors") == 0
    return evaluated.select(
        *[name for name in evaluated.columns if name != "payload_variant"],
        log_order().alias("ord"),
        F.when(
            is_event,
            ids.fingerprint(
                event_type=F.col("event_type"),
                system=F.col("source.system"),
                source_object=F.col("source.object"),
                entity_type=F.col("entity_type"),
                entity_key=F.col("entity_key"),
                entity_version=F.col("entity_version"),
                occurred_at=F.col("occurred_at"),
                payload=F.col("payload"),
                payload_variant=F.col("payload_variant"),
            ),
        ).alias("fingerprint"),
        is_event.alias("is_event"),
        F.array_contains(F.col("violations.severity"), "reject").alias("breaks_rule"),
        _unstorable().alias("unstorable"),
    )


def _unstorable() -> Column:
    """Whether a stored text holds NUL: the payload as an escape, the others as they are."""
    found = F.coalesce(has_nul(F.col("payload")), F.lit(False))
    for name in ("entity_key", "entity_type", "source.system", "source.object"):
        found = found | F.coalesce(F.contains(F.col(name), F.lit("\0")), F.lit(False))
    return found


def has_nul(payload_text: Column) -> Column:
    """Whether a JSON text holds an escaped NUL (and not an escaped backslash)."""
    plain = F.replace(payload_text, F.lit("\\\\"), F.lit(""))
    return F.when(
        F.contains(payload_text, F.lit(NUL_ESCAPE)), F.contains(plain, F.lit(NUL_ESCAPE))
    ).otherwise(F.lit(False))


def first_acceptable(examined: DataFrame) -> DataFrame:
    """Per event id the first record that may be logged, and the record count."""
    ok = ~F.col("breaks_rule") & ~F.col("unstorable")
    first = F.min(F.when(ok, F.struct("ord", "fingerprint")))
    return (
        examined.where(F.col("is_event") & F.col("event_id").isNotNull())
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"), first.alias("_first"))
        .select(
            "event_id",
            "copies",
            F.col("_first.ord").alias("first_ord"),
            F.col("_first.fingerprint").alias("first_fingerprint"),
        )
    )


def known_fingerprints(events: DataFrame, event_log: DataFrame) -> DataFrame:
    """The ids of a batch that the log holds, with the logged fingerprint."""
    wanted = events.select("event_id").where(F.col("event_id").isNotNull()).distinct()
    return event_log.select("event_id", "fingerprint").join(
        wanted, "event_id", "left_semi"
    )


def with_known(firsts: DataFrame, event_log: DataFrame | None) -> DataFrame:
    """Add the fingerprint already in the log, one lookup per distinct id."""
    if event_log is None:
        return firsts.withColumn("known_fingerprint", F.lit(None).cast("string"))
    known = known_fingerprints(firsts, event_log)
    return firsts.join(
        known.withColumnRenamed("fingerprint", "known_fingerprint"), "event_id", "left"
    )


def judge(examined: DataFrame, event_log: DataFrame | None = None) -> DataFrame:
    """Add ``verdict`` and ``logged_fingerprint`` to every examined record."""
    summary = with_known(first_acceptable(examined), event_log)
    # Ids recovered from the headers of unreadable records take no part.
    keyed = examined.withColumn("_id", F.when(F.col("is_event"), F.col("event_id")))
    rows = attach_summary(
        keyed,
        summary.withColumnRenamed("event_id", "_id"),
        key="_id",
        weight="copies",
        spread=F.col("ord"),
    ).drop("_id")
    logged = F.coalesce("known_fingerprint", "first_fingerprint")
    known = F.col("known_fingerprint").isNotNull() | F.coalesce(
        F.col("ord") > F.col("first_ord"), F.lit(False)
    )
    verdict = (
        F.when(~F.col("is_event"), F.lit(SCHEMA_VIOLATION))
        .when(known & (F.col("fingerprint") == logged), F.lit(DUPLICATE))
        .when(known, F.lit(EVENT_ID_CONFLICT))
        .when(F.col("breaks_rule"), F.lit(QUALITY_RULE_FAILED))
        .when(F.col("unstorable"), F.lit(SINK_REJECTED))
        .otherwise(F.lit(ACCEPTED))
    )
    return rows.withColumn("verdict", verdict).withColumn(
        "logged_fingerprint", F.when(known, logged)
    ).drop("known_fingerprint", "first_fingerprint", "first_ord")


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("verdict") == ACCEPTED)


def versions_of(events: DataFrame, state: DataFrame) -> DataFrame:
    """The current version of the entities a batch touches."""
    keys = ["entity_type", "entity_key"]
    touched = events.select(*keys).distinct()
    return state.select(*keys, "entity_version").join(
        touched, keys, "left_semi"
    )


def with_outcome(events: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """Add ``outcome`` to accepted events: applied, or stale if not the newest.

    ``versions`` holds the current ``entity_version`` per entity from before; it
    takes part as a row that precedes every event of its entity. An equal version
    is stale: the first arrival stays.
    """
    rows = events.withColumn("_is_event", F.lit(True))
    if versions is not None:
        before = versions.select(
            "entity_type",
            "entity_key",
            "entity_version",
            F.lit(-1).cast("bigint").alias("ord"),
            F.lit(False).alias("_is_event"),
        )
        rows = rows.unionByName(before, allowMissingColumns=True)
    compared = max_before(
        rows,
        keys=["entity_type", "entity_key"],
        order="ord",
        block=order_block(F.col("ord")),
        value="entity_version",
        into="_newest",
    )
    applied = F.col("entity_version") > F.coalesce("_newest", F.lit(0))
    return (
        compared.where("_is_event")
        .withColumn("outcome", F.when(applied, F.lit(APPLIED)).otherwise(F.lit(STALE)))
        .drop("_newest", "_is_event")
    )


def best_versions(events: DataFrame, processed_at: Column) -> DataFrame:
    """The state each entity reaches by these events: highest version, first arrival."""
    keys = ("entity_type", "entity_key")
    content = F.struct(
        "entity_version", "payload", "source", "event_id", "event_type", "occurred_at"
    )
    newest = F.max_by(content, F.struct(F.col("entity_version"), -F.col("ord")))
    return events.groupBy(*keys).agg(newest.alias("_new")).select(
        *keys,
        F.col("_new.entity_version").alias("entity_version"),
        F.col("_new.payload").alias("payload"),
        F.col("_new.source").alias("source"),
        F.col("_new.event_id").alias("last_event_id"),
        F.col("_new.event_type").alias("last_event_type"),
        F.col("_new.occurred_at").alias("occurred_at"),
        processed_at.alias("updated_at"),
    )


def newer_only(best: DataFrame, versions: DataFrame | None) -> DataFrame:
    """Drop the entities whose current version is as new."""
    if versions is None:
        return best
    keys = ["entity_type", "entity_key"]
    current = versions.select(*keys, F.col("entity_version").alias("_current"))
    newer = F.col("entity_version") > F.coalesce("_current", F.lit(0))
    return best.join(current, keys, "left").where(newer).drop("_current")


def merge_state(current: DataFrame, best: DataFrame) -> DataFrame:
    """Current state after the events: the row with the higher version wins."""
    keys = ["entity_type", "entity_key"]
    values = [name for name in current.columns if name not in keys]
    old, new = F.struct(*values).alias("_old"), F.struct(*values).alias("_new")
    both = current.select(*keys, old).join(best.select(*keys, new), keys, "full_outer")
    replaced = F.col("_old").isNull() | (
        F.col("_new.entity_version") > F.col("_old.entity_version")
    )
    row = F.when(replaced, F.col("_new")).otherwise(F.col("_old"))
    return both.select(*keys, row.alias("_row")).select(*keys, "_row.*")


def quarantine_rows(
    judged: DataFrame, ruleset: str, quarantined_at: Column, *, sequence: str = "log_seq"
) -> DataFrame:
    """The rejected records, each quarantine id once (its first record stays)."""
    rejected = judged.where(F.col("verdict").isin(*QUARANTINE_REASONS))
    is_event = F.col("verdict") != SCHEMA_VIOLATION
    details = (
        F.when(~is_event, F.to_json(F.struct("errors")))
        .when(
            F.col("verdict") == EVENT_ID_CONFLICT,
            F.to_json(
                F.struct(
                    "logged_fingerprint", F.col("fingerprint").alias("incoming_fingerprint")
                )
            ),
        )
        .when(F.col("verdict") == QUALITY_RULE_FAILED, F.to_json(F.struct("violations")))
        .otherwise(F.to_json(F.struct(F.lit(UNSTORABLE).alias("error"))))
    )
    rows = rejected.select(
        F.when(
            is_event,
            ids.event_quarantine_id(F.col("event_id"), F.col("fingerprint"), F.col("verdict")),
        )
        .otherwise(
            ids.record_quarantine_id(F.col("topic"), F.col("partition"), F.col("offset"))
        )
        .alias("quarantine_id"),
        F.col(sequence).alias("quarantine_seq"),
        F.col("verdict").alias("reason"),
        details.alias("details"),
        "event_id",
        F.when(is_event, F.col("entity_type")).alias("entity_type"),
        "entity_key",
        "batch_id",
        F.when(is_event, F.lit(ruleset)).alias("ruleset_fingerprint"),
        readable(F.col("value")).alias("raw_value"),
        F.col("value").alias("raw_bytes"),
        "topic",
        "partition",
        "offset",
        "ord",
    )
    content = [name for name in rows.columns if name not in ("quarantine_id", "ord")]
    # The copies of one rejected event meet only after each task kept its first.
    first = F.min_by(F.struct(*content), F.col("ord"))
    return (
        rows.groupBy("quarantine_id")
        .agg(first.alias("_row"))
        .select("quarantine_id", "_row.*", quarantined_at.alias("quarantined_at"))
    )


def outcome_of(verdict: Column, applied_or_stale: Column) -> Column:
    return (
        F.when(verdict == ACCEPTED, applied_or_stale)
        .when(verdict == DUPLICATE, F.lit(DUPLICATE))
        .otherwise(F.lit(QUARANTINED))
    )


def outcome_counts(judged: DataFrame, events: DataFrame) -> DataFrame:
    """Records per outcome; ``events`` are the accepted ones with their outcome."""
    others = judged.where(F.col("verdict") != ACCEPTED).select(
        outcome_of(F.col("verdict"), F.lit(None).cast("string")).alias("outcome")
    )
    return (
        events.select("outcome")
        .unionByName(others)
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("records"))
    )
