"""Resolve one set of log records into the tables, as one epoch."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.operators import positions, resolve
from changefeed.operators.rules import RuleSet, with_severity
from changefeed.schemas import ACCEPTED, DUPLICATE, RECORDS
from changefeed.session import stage
from changefeed.sources.log import commit_offsets
from changefeed.streaming.tables import Tables


def resolve_epoch(
    records: DataFrame,
    tables: Tables,
    rules: RuleSet,
    epoch: int | None = None,
    *,
    batch: tuple[str, int] | None = None,
    streams: dict[str, int] | None = None,
    examined: DataFrame | None = None,
) -> int:
    """Judge ``records`` and write the next epoch; returns the records read.

    Epochs are numbered by the tables. ``batch`` is the stream and its batch number that
    the records are; a batch that a commit names is skipped, whatever was committed since.
    ``streams`` are batches that tables without commits take as known. A caller that
    numbers epochs itself gives ``epoch``, and one that is committed is skipped.
    ``examined`` is a staged copy of the records as ``resolve.examine`` reads them under
    ``rules``, if there is one; otherwise they are decoded here.

    Every record is decoded once (the staged copy) and shuffled once (by event
    id); the accepted rows then are the event log, nothing copies them.
    """
    last = tables.last_commit()
    known = {**(streams or {}), **last.streams}
    if batch is not None:
        if known.get(batch[0], -1) >= batch[1]:
            return 0  # committed before a restart
        known[batch[0]] = batch[1]
    if epoch is None:
        epoch = last.epoch + 1
    if epoch <= last.epoch:
        return 0
    if epoch != last.epoch + 1:
        raise ValueError(f"epoch {epoch} cannot follow epoch {last.epoch}")
    if examined is None:
        examined = stage(
            resolve.examine(records, rules), "examined", path=f"{tables.root}/staging"
        )
    spans = positions.partition_spans(examined, last.next_seq)
    # One row per log partition; the counts come from the staged file footers.
    totals = spans.agg(
        F.coalesce(F.max(F.col("first_seq") + F.col("span") - 1), F.lit(last.next_seq))
    ).first()
    count = examined.count()
    first_epoch = last.epoch < 0
    ids = examined.select("event_id").where(F.col("is_event") & F.col("event_id").isNotNull())
    # The sequence tells the order of all topics' records; that of one topic has no other.
    numbered = positions.with_sequence(examined, spans).withColumn("ord", F.col("log_seq"))
    # Only accepted records keep their payload, so it need not be shuffled with the others.
    refused = F.coalesce(~F.col("is_event") | F.col("breaks_rule") | F.col("unstorable"), F.lit(False))
    numbered = resolve.judge(
        numbered.withColumn("payload", F.when(~refused, F.col("payload"))),
        None if first_epoch else tables.logged.matching(ids, epoch - 1),
    )
    tables.write(_stored(numbered), "records", epoch, "verdict")
    written = tables.records(epoch + 1).where(F.col("epoch") == epoch)

    events = written.where(F.col("verdict") == ACCEPTED)
    narrow = events.select("entity_type", "entity_key", "entity_version", "ord")
    versions = None if first_epoch else tables.versions.matching(narrow, epoch - 1)
    touched = None if versions is None else resolve.versions_of(narrow, versions)
    decided = resolve.with_outcome(narrow, touched)
    best = resolve.best_versions(events, F.current_timestamp())
    rejected = written.where(~F.col("verdict").isin(ACCEPTED, DUPLICATE))
    found = resolve.quarantine_rows(
        rejected.withColumnRenamed("raw_bytes", "value"),
        rules.fingerprint,
        F.current_timestamp(),
    )
    if not first_epoch:
        earlier = tables.quarantined.matching(found.select("quarantine_id"), epoch - 1)
        found = found.join(earlier, "quarantine_id", "left_anti")
    sinks = {
        "outcomes": resolve.outcome_counts(written, decided).coalesce(1),
        "state": resolve.newer_only(best, None if touched is None else _highest(touched)),
        "quarantine": found,
        "offsets": commit_offsets(examined).coalesce(1),
    }
    # They read what is written already; side by side they fill the cluster.
    with ThreadPoolExecutor(len(sinks) + 1) as pool:
        writes = {name: pool.submit(tables.write, df, name, epoch) for name, df in sinks.items()}
        logged = pool.submit(tables.logged.add, events, epoch)
        writes["state"].result()
        changed = pool.submit(tables.versions.add, tables.written("state", epoch), epoch)
        writes["quarantine"].result()
        tables.quarantined.add(tables.written("quarantine", epoch), epoch)
        for write in (*writes.values(), logged, changed):
            write.result()
    tables.commit(epoch, next_seq=totals[0], records=count, streams=known)
    tables.tidy()
    return count


def _highest(versions: DataFrame) -> DataFrame:
    return versions.groupBy("entity_type", "entity_key").agg(
        F.max("entity_version").alias("entity_version")
    )


def _stored(numbered: DataFrame) -> DataFrame:
    """The columns kept per record: the content of accepted ones, the raw bytes of
    rejected ones, only ids and position of duplicates."""
    is_accepted = F.col("verdict") == ACCEPTED
    is_rejected = ~F.col("verdict").isin(ACCEPTED, DUPLICATE)
    shaped = (
        numbered.withColumn(
            "quality_warnings",
            F.when(is_accepted, with_severity(F.col("violations"), "warn")),
        )
        .withColumn("payload", F.when(is_accepted, F.col("payload")))
        .withColumn("raw_bytes", F.when(is_rejected, F.col("value")))
        .withColumn("violations", F.when(is_rejected, F.col("violations")))
        .withColumn("errors", F.when(is_rejected, F.col("errors")))
    )
    return shaped.select(*RECORDS, "verdict")
