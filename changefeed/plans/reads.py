"""The read side: filters, pages, entity views and statistics as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.functions.text import page_position, page_token
from changefeed.functions.times import moment, seconds_between
from changefeed.operators.quantiles import exact_quantiles

_ENTITY = ["entity_type", "entity_key"]


class InvalidPage(ValueError):
    """A page token that this module did not make."""


@dataclass(frozen=True)
class EventFilters:
    entity_key: str | None = None
    entity_type: str | None = None
    event_type: str | None = None
    batch_id: str | None = None
    occurred_after: datetime | None = None
    occurred_before: datetime | None = None

    def __post_init__(self) -> None:
        start, end = self.occurred_after, self.occurred_before
        if start is not None and end is not None and start >= end:
            raise ValueError("occurred_after must be earlier than occurred_before")


def filter_events(log: DataFrame, filters: EventFilters) -> DataFrame:
    """All given conditions; the time window is half open."""
    for name in ("entity_key", "entity_type", "event_type", "batch_id"):
        wanted = getattr(filters, name)
        if wanted is not None:
            log = log.where(F.col(name) == wanted)
    if filters.occurred_after is not None:
        log = log.where(F.col("occurred_at") >= moment(filters.occurred_after))
    if filters.occurred_before is not None:
        log = log.where(F.col("occurred_at") < moment(filters.occurred_before))
    return log


def filter_quarantine(
    quarantine: DataFrame, *, reason: str | None = None, entity_key: str | None = None
) -> DataFrame:
    if reason is not None:
        quarantine = quarantine.where(F.col("reason") == reason)
    if entity_key is not None:
        quarantine = quarantine.where(F.col("entity_key") == entity_key)
    return quarantine


def page(rows: DataFrame, sequence: str, *, limit: int, before: int | None = None) -> DataFrame:
    """Newest first; one row more than ``limit`` tells that another page follows."""
    if before is not None:
        rows = rows.where(F.col(sequence) < before)
    return rows.orderBy(F.col(sequence).desc()).limit(limit + 1)


def page_with_next(
    rows: DataFrame, sequence: str, *, limit: int, token: str | None = None
) -> tuple[DataFrame, str | None]:
    """A page and the token of the next one."""
    before = None if token is None else decode_token(rows, token)
    found = page(rows, sequence, limit=limit, before=before)
    ordered = Window.orderBy(F.col(sequence).desc())
    # At most limit + 1 rows.
    numbered = found.withColumn("_n", F.row_number().over(ordered))
    last = numbered.agg(
        F.max("_n").alias("n"), F.max(F.when(F.col("_n") == limit, F.col(sequence))).alias("seq")
    ).select("n", page_token(F.col("seq")).alias("token")).first()
    more = last["n"] is not None and last["n"] > limit
    return numbered.where(F.col("_n") <= limit).drop("_n"), last["token"] if more else None


def decode_token(rows: DataFrame, token: str) -> int:
    spark = rows.sparkSession
    before = spark.range(1).select(page_position(F.lit(token))).first()[0]
    if before is None:
        raise InvalidPage("malformed pagination cursor")
    return before


def event_by_id(log: DataFrame, event_id: str) -> DataFrame:
    return log.where(F.col("event_id") == event_id)


def log_position() -> Column:
    return F.struct("topic", "partition", "offset")


def state_by_key(state: DataFrame, entity_type: str, key: str) -> DataFrame:
    return state.where((F.col("entity_type") == entity_type) & (F.col("entity_key") == key))


def entity_types(state: DataFrame, log: DataFrame) -> DataFrame:
    """Every (entity_type, entity_key) known to the state or the log, once."""
    return state.select(*_ENTITY).union(log.select(*_ENTITY)).distinct()


def ambiguous_keys(state: DataFrame, log: DataFrame) -> DataFrame:
    """Keys that exist under several entity types: one row per key and type."""
    types = entity_types(state, log)
    several = (
        types.groupBy("entity_key").agg(F.count(F.lit(1)).alias("types")).where("types > 1")
    )
    return types.join(several, "entity_key").select("entity_key", "entity_type", "types")


def latest_per_entity(rows: DataFrame, sequence: str, *, limit: int, keys: list[str]) -> DataFrame:
    """The newest ``limit`` rows per key and whether older ones exist.

    The rank filter reaches below the shuffle (each task keeps the newest
    ``limit + 1`` rows of a key), so a key with many rows stays small.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(sequence).desc())
    ranked = rows.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= limit + 1)
    cut = F.max("_n").over(Window.partitionBy(*keys)) > limit
    return ranked.withColumn("truncated", cut).where(F.col("_n") <= limit).drop("_n")


def entity_history(log: DataFrame, *, limit: int) -> DataFrame:
    return latest_per_entity(log, "log_seq", limit=limit, keys=_ENTITY)


def entity_view(
    state: DataFrame, log: DataFrame, quarantine: DataFrame, *, limit: int
) -> DataFrame:
    """Current state, newest events (oldest first) and newest rejections per entity.

    The lists hold at most ``limit`` items each. Rejections are listed by key alone,
    under every type of the key; a key that has nothing else has no type.
    """
    events = entity_history(log, limit=limit).groupBy(*_ENTITY).agg(
        F.sort_array(
            F.collect_list(F.struct("log_seq", "event_id", "event_type", "entity_version"))
        ).alias("history"),
        F.max("truncated").alias("history_truncated"),
    )
    rejected = latest_per_entity(
        quarantine.where(F.col("entity_key").isNotNull()),
        "quarantine_seq",
        limit=limit,
        keys=["entity_key"],
    )
    rejections = rejected.groupBy("entity_key").agg(
        F.sort_array(
            F.collect_list(F.struct("quarantine_seq", "quarantine_id", "reason")), asc=False
        ).alias("quarantined")
    )
    current = state.select(*_ENTITY, "entity_version", "payload", "last_event_id")
    return current.join(events, _ENTITY, "full_outer").join(
        rejections, "entity_key", "full_outer"
    )


def entity_view_of(
    state: DataFrame, log: DataFrame, quarantine: DataFrame, entity_key: str, *, limit: int
) -> DataFrame:
    """The view of one key, for each of its types; the key reaches the scans."""
    mine = [df.where(F.col("entity_key") == entity_key) for df in (state, log, quarantine)]
    return entity_view(*mine, limit=limit)


def orphan_states(state: DataFrame, log: DataFrame) -> DataFrame:
    """States whose event is not in the log; there should be none."""
    logged = log.select(F.col("event_id").alias("last_event_id"))
    return state.join(logged, "last_event_id", "left_anti")


def events_by_type(log: DataFrame) -> DataFrame:
    return log.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def quarantine_by_reason(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def violations_by_rule(quarantine: DataFrame) -> DataFrame:
    """How often each rule failed among the rejected events."""
    listed = F.from_json(
        "details", "violations array<struct<rule:string,field:string,severity:string>>"
    )["violations"]
    return (
        quarantine.where(F.col("reason") == "quality_rule_failed")
        .select(F.explode_outer(listed).alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy(F.col("v.rule").alias("rule"), F.col("v.severity").alias("severity"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """Frames of one row each as one row, without a join."""
    stacked = single_rows[0]
    for other in single_rows[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def stats_totals(log: DataFrame, state: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row of totals, each table read once."""
    events = log.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.size("quality_warnings") > 0).alias("warned"),
        F.max("occurred_at").alias("latest_occurred"),
        F.max("processed_at").alias("latest_processed"),
    )
    entities = state.agg(F.count(F.lit(1)).alias("entities"))
    duplicates = outcomes.where(F.col("outcome") == "duplicate").agg(
        F.coalesce(F.max("records"), F.lit(0).cast("bigint")).alias("duplicates")
    )
    return side_by_side(events, entities, duplicates)


def record_lag(log: DataFrame) -> DataFrame:
    return log.withColumn("lag_seconds", seconds_between(F.col("processed_at"), F.col("occurred_at")))


def lag_stats(log: DataFrame) -> DataFrame:
    """Lag of all events of a log (or of a time window of it), from change to table and
    for its two legs."""
    legs = {
        "end_to_end": ("processed_at", "occurred_at"),
        "capture": ("captured_at", "occurred_at"),
        "delivery": ("processed_at", "captured_at"),
    }
    micros = log.select(
        *[(F.unix_micros(late) - F.unix_micros(early)).alias(name) for name, (late, early) in legs.items()]
    )
    found = exact_quantiles(micros, [0.5, 0.95])

    def percentile(name: str, fraction: float) -> Column:
        if found[name, fraction] is None:
            return F.lit(None).cast("double")
        lower, upper, weight = found[name, fraction]
        return F.round(F.lit((1 - weight) * (lower / 1e6) + weight * (upper / 1e6)), 3)

    measured = log.select(
        *[seconds_between(F.col(late), F.col(early)).alias(name) for name, (late, early) in legs.items()]
    )
    figures = [F.count(F.lit(1)).alias("sample_size")]
    for name in legs:
        figures += [
            F.round(F.avg(name), 3).alias(f"{name}_avg"),
            percentile(name, 0.5).alias(f"{name}_p50"),
            percentile(name, 0.95).alias(f"{name}_p95"),
            F.round(F.max(name), 3).alias(f"{name}_max"),
        ]
    return measured.agg(*figures)


def latest_event(log: DataFrame) -> DataFrame:
    return log.orderBy(F.col("log_seq").desc()).limit(1)


def recent_batches(batches: DataFrame, *, limit: int = 5) -> DataFrame:
    return batches.orderBy(F.col("started_at").desc(), F.col("batch_id")).limit(limit)


def watermarks(cycles: DataFrame) -> DataFrame:
    """The newest committed position per source, ordered by source."""
    committed = cycles.where(F.col("status") == "committed")
    newest = F.struct("cycle", "cursor_at", "cursor_key", "last_batch_id")
    return (
        committed.groupBy("source_id")
        .agg(
            F.max(F.when(F.col("cursor_at").isNotNull(), newest)).alias("_last"),
            F.min(F.when(F.col("caught_up"), F.col("finished_at"))).alias(
                "initial_sync_completed_at"
            ),
        )
        .select(
            "source_id",
            F.col("_last.cursor_at").alias("cursor_updated_at"),
            F.col("_last.cursor_key").alias("cursor_key"),
            F.col("_last.last_batch_id").alias("last_batch_id"),
            "initial_sync_completed_at",
        )
        .orderBy("source_id")
    )


def checksum(rows: DataFrame, content: list[str], *, prefix: str) -> DataFrame:
    """Row count and an order-free checksum of ``content``, as one row.

    Each row gives two 60-bit numbers from its MD5; their sums do not depend on
    the order of the rows, so no task has to see all of them.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(name).cast("string") for name in content]))

    def part(start: int) -> Column:
        number = F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")
        total = F.sum(number.cast("decimal(38,0)"))
        return F.coalesce(total, F.lit(0).cast("decimal(38,0)")).cast("string")

    return rows.agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.md5(F.concat_ws("|", part(1), part(16))).alias(f"{prefix}_checksum"),
    )


# Times and log positions stay out: a rebuild may change them.
STATE_CONTENT = ["entity_type", "entity_key", "entity_version", "payload", "last_event_id"]
LOG_CONTENT = ["event_id", "fingerprint"]
QUARANTINE_CONTENT = ["quarantine_id"]


def table_checksums(state: DataFrame, log: DataFrame, quarantine: DataFrame) -> DataFrame:
    return side_by_side(
        checksum(state, STATE_CONTENT, prefix="state"),
        checksum(log, LOG_CONTENT, prefix="log"),
        checksum(quarantine, QUARANTINE_CONTENT, prefix="quarantine"),
    )
