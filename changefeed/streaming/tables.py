"""The tables of the pipeline as Parquet folders with an epoch commit.

An epoch writes its folders, each replaced on a retry, and its commit last.
Readers take only epochs up to the last commit, and epoch N looks only at epochs
before N, so computing N again gives the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.schemas import (
    ACCEPTED,
    COMMIT,
    EVENT_LOG_COLUMNS,
    OFFSETS,
    OUTCOMES,
    QUARANTINE,
    RECORDS,
    REJUDGED,
    STATE,
    ddl,
)
from changefeed.session import delete_path, numbered_folders, path_exists
from changefeed.streaming.runs import Runs

_ENTITY = ["entity_type", "entity_key"]


@dataclass(frozen=True)
class LastCommit:
    epoch: int
    next_seq: int
    streams: dict[str, int]


class Tables:
    """One generation of the sink tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        index = lambda name, columns, keys, **more: Runs(
            spark, f"{self.root}/index/{name}", columns, keys, **more
        )
        # What an epoch looks up: ids that are logged, versions of entities, quarantined ids.
        self.logged = index("logged", {"event_id": "string", "fingerprint": "string"}, ("event_id",))
        self.versions = index(
            "versions",
            {"entity_type": "string", "entity_key": "string", "entity_version": "bigint"},
            ("entity_type", "entity_key"),
            newest="entity_version",
        )
        self.quarantined = index("quarantined", {"quarantine_id": "string"}, ("quarantine_id",))

    def path(self, table: str, epoch: int | None = None) -> str:
        folder = f"{self.root}/{table}"
        return folder if epoch is None else f"{folder}/epoch={epoch}"

    def exists(self, path: str) -> bool:
        return path_exists(self.spark, path)

    def write(self, df: DataFrame, table: str, epoch: int, *partitions: str) -> None:
        writer = df.write.mode("overwrite")
        if table == "records":
            # Point lookups by id skip the row groups that cannot hold it.
            writer = writer.option("parquet.bloom.filter.enabled#event_id", "true").option(
                "parquet.bloom.filter.adaptive.enabled", "true"
            )
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(self.path(table, epoch))

    def written(self, table: str, epoch: int) -> DataFrame:
        """What an epoch that is not committed yet wrote."""
        columns = {"state": STATE, "quarantine": QUARANTINE}[table]
        return self.spark.read.schema(ddl(columns)).parquet(self.path(table, epoch))

    def commit(
        self, epoch: int, *, next_seq: int, records: int, streams: dict[str, int] | None = None
    ) -> None:
        """``streams`` has the last batch taken from each stream, over all epochs so far."""
        pairs = [F.lit(x) for pair in (streams or {}).items() for x in pair]
        row = self.spark.range(1).select(
            F.lit(next_seq).cast("bigint").alias("next_seq"),
            F.lit(records).cast("bigint").alias("records"),
            F.current_timestamp().alias("committed_at"),
            F.create_map(*pairs).cast("map<string,bigint>").alias("streams"),
        )
        # Fails if another writer committed this epoch.
        row.coalesce(1).write.mode("error").parquet(self.path("commits", epoch))

    def last_commit(self) -> LastCommit:
        """Epochs are committed one after the other, so the newest covers all."""
        done = numbered_folders(self.spark, self.path("commits"), "epoch")
        if not done:
            return LastCommit(-1, 0, {})
        newest = max(done)
        row = self.spark.read.schema(ddl(COMMIT)).parquet(self.path("commits", newest)).first()
        return LastCommit(newest, row["next_seq"], dict(row["streams"] or {}))

    def commits(self) -> DataFrame:
        return self._read("commits", COMMIT, None)

    def _read(
        self, table: str, columns: dict[str, str], before: int | None, **partitions: str
    ) -> DataFrame:
        """All epochs of a table, or those before one; pruned by folder."""
        schema = ddl(columns, partitions, {"epoch": "bigint"})
        path = self.path(table)
        if not self.exists(path):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(path)
        return df if before is None else df.where(F.col("epoch") < before)

    def _end(self, before: int | None) -> int:
        if before is not None:
            return before
        return max(numbered_folders(self.spark, self.path("commits"), "epoch"), default=-1) + 1

    def records(self, before: int | None = None) -> DataFrame:
        """Every record with its verdict."""
        return self._read("records", RECORDS, self._end(before), verdict="string")

    def event_log(self, before: int | None = None) -> DataFrame:
        """The accepted events. ``processed_at`` is the commit time of their epoch."""
        end = self._end(before)
        rows = self.records(end).where(F.col("verdict") == ACCEPTED)
        times = self.commits().select("epoch", F.col("committed_at").alias("processed_at"))
        return rows.join(times, "epoch").select(*EVENT_LOG_COLUMNS)

    def logged_fingerprints(self, before: int | None = None) -> DataFrame:
        return (
            self.records(before)
            .where(F.col("verdict") == ACCEPTED)
            .select("event_id", "fingerprint")
        )

    def quarantine(self, before: int | None = None) -> DataFrame:
        return self._read("quarantine", QUARANTINE, self._end(before)).drop("epoch")

    def rejudged(self) -> DataFrame:
        """The quarantined events that ran again, by the rule set that judged them then."""
        return self._read("rejudged", REJUDGED, self._end(None)).drop("epoch")

    def outcomes(self, before: int | None = None) -> DataFrame:
        """Records per outcome over all epochs."""
        rows = self._read("outcomes", OUTCOMES, self._end(before))
        return rows.groupBy("outcome").agg(F.sum("records").alias("records"))

    def epoch_outcomes(self, epoch: int) -> DataFrame:
        rows = self._read("outcomes", OUTCOMES, epoch + 1).where(F.col("epoch") == epoch)
        return rows.select("outcome", "records")

    def duplicates_skipped(self) -> int:
        row = self.outcomes().where(F.col("outcome") == "duplicate").first()
        return row["records"] if row else 0

    def committed_offsets(self, before: int | None = None) -> DataFrame:
        rows = self._read("offsets", OFFSETS, self._end(before))
        return rows.groupBy("topic", "partition").agg(
            F.max("committed_offset").alias("committed_offset")
        )

    def _state_rows(self, before: int | None) -> DataFrame:
        """The newest snapshot and the changes since, with several rows per entity."""
        end = self._end(before)
        changes = self._read("state", STATE, end)
        snapshots = self._read("state_snapshot", STATE, None)
        base = self._snapshot_epoch(end)
        if base is None:
            return changes.drop("epoch")
        return (
            snapshots.where(F.col("epoch") == base)
            .unionByName(changes.where(F.col("epoch") > base))
            .drop("epoch")
        )

    def _snapshot_epoch(self, end: int) -> int | None:
        done = numbered_folders(self.spark, self.path("state_snapshot_done"), "epoch")
        return max((epoch for epoch in done if epoch < end), default=None)

    def current_state(self, before: int | None = None) -> DataFrame:
        """One row per entity. A change is written only if its version is higher,
        so the highest version is the newest."""
        rows = self._state_rows(before)
        values = [name for name in STATE if name not in _ENTITY]
        newest = F.max_by(F.struct(*values), F.col("entity_version"))
        return rows.groupBy(*_ENTITY).agg(newest.alias("_row")).select(*_ENTITY, "_row.*")

    def current_versions(self, before: int | None = None) -> DataFrame:
        """Version per entity, possibly several rows; three columns are read."""
        return self._state_rows(before).select(*_ENTITY, "entity_version")

    def tidy(self, *, every: int = 16) -> None:
        """Drop what the last epoch staged and what only old readers needed; every so many
        epochs fold the changes of the state into a snapshot."""
        epoch = self.last_commit().epoch
        delete_path(self.spark, f"{self.root}/staging")
        for runs in (self.logged, self.versions, self.quarantined):
            runs.retire(epoch)
        if epoch % every == every - 1:
            self.compact_state()

    def compact_state(self) -> None:
        """Fold the changes into a snapshot, so that reads start from there."""
        epoch = self.last_commit().epoch
        if epoch < 0 or self._snapshot_epoch(epoch + 1) == epoch:
            return
        self.write(self.current_state(), "state_snapshot", epoch)
        done = self.spark.range(1).select(
            F.lit(0).cast("bigint").alias("next_seq"),
            F.lit(0).cast("bigint").alias("records"),
            F.current_timestamp().alias("committed_at"),
        )
        done.coalesce(1).write.mode("overwrite").parquet(self.path("state_snapshot_done", epoch))


class Generations:
    """Rebuilds write a new generation; a pointer row tells which one is current.

    This takes the place of emptying the tables: readers keep the old generation
    until the new one is complete.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def current_number(self) -> int:
        return max(numbered_folders(self.spark, f"{self.root}/current", "generation"), default=0)

    def current(self) -> Tables:
        return self.tables(self.current_number())

    def tables(self, number: int) -> Tables:
        return Tables(self.spark, f"{self.root}/generation={number}")

    def next_free(self) -> int:
        number = self.current_number() + 1
        while path_exists(self.spark, f"{self.root}/generation={number}"):
            number += 1  # left over from a rebuild that did not finish
        return number

    def retire(self, *, keep: int = 1) -> None:
        """Delete the generations before the current one, but for the last ``keep`` of them,
        which readers that began before the switch may still use."""
        current = self.current_number()
        for number in numbered_folders(self.spark, self.root, "generation"):
            if number < current - keep:
                delete_path(self.spark, f"{self.root}/generation={number}")

    def switch_to(self, number: int) -> None:
        row = self.spark.range(1).select(F.current_timestamp().alias("switched_at"))
        row.coalesce(1).write.mode("error").parquet(f"{self.root}/current/generation={number}")
