"""One capture cycle: changed rows to events in the log, then the watermark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefeed.functions import ids
from changefeed.functions.times import from_micros, moment
from changefeed.operators import positions
from changefeed.operators.envelope import SourceSpec, to_events, to_log_values
from changefeed.schemas import EVENT_ID_NAMESPACE, LOG_RECORD, ddl
from changefeed.session import stage
from changefeed.sources import changes
from changefeed.sources.log import LOG_PARTITIONS, end_offsets, log_partition, read_log
from changefeed.streaming.ledger import Ledger, SyncState
from changefeed.streaming.tables import path_exists

BATCH_SIZE = 2_000
SETTLE_SECONDS = 10
_INTERNAL = ("_block", "_row", "_shared", "_rank", "_batch", "_partition")


@dataclass(frozen=True)
class CycleResult:
    mode: str
    batches: int
    rows: int
    caught_up: bool


def _now(spark: SparkSession) -> datetime:
    return from_micros(spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0])


def batch_number(rank: Column, batch_size: int) -> Column:
    """Batches are cut along the order; rows with equal times may be split."""
    return F.floor((rank - 1) / F.lit(batch_size))


def batch_summary(events: DataFrame, batch: str, *, at: str, key: str) -> DataFrame:
    """One row per batch: counts, the position it reaches, first and last event."""
    place = F.struct(F.col(at).alias("at"), F.col(key).alias("key"))
    return (
        events.groupBy(batch)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col("event_type") == "insert").alias("inserts"),
            F.count_if(F.col("event_type") == "update").alias("updates"),
            F.max(place).alias("_end"),
            F.min_by("event_id", place).alias("first_event_id"),
            F.max_by("event_id", place).alias("last_event_id"),
        )
        .select(
            batch,
            "row_count",
            "inserts",
            "updates",
            F.col("_end.at").alias("cursor_end_at"),
            F.col("_end.key").alias("cursor_end_key"),
            "first_event_id",
            "last_event_id",
        )
    )


class Capture:
    """Captures one source into the Parquet log under ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        spec: SourceSpec,
        *,
        topic: str = "changes",
        partitions: int = LOG_PARTITIONS,
        batch_size: int = BATCH_SIZE,
        settle_seconds: int = SETTLE_SECONDS,
        publish: Callable[[DataFrame, str], None] | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.topic = topic
        self.partitions = partitions
        self.batch_size = batch_size
        self.settle_seconds = settle_seconds
        self.ledger = Ledger(spark, self.root)
        self._publish = publish or _append

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def log(self) -> DataFrame:
        if not path_exists(self.spark, self.log_path):
            return self.spark.createDataFrame([], ddl(LOG_RECORD))
        return read_log(self.spark, self.log_path)

    def run_cycle(
        self,
        source: DataFrame,
        *,
        as_of: datetime | None = None,
        max_batches: int | None = None,
    ) -> CycleResult:
        """Publish what changed up to the settle bound.

        The whole window is one job, not one query per batch; the batches only
        cut it for the ledger. ``max_batches`` ends the cycle early.
        """
        spec = self.spec
        changes.check_columns(source, spec)
        whole_key = changes.is_whole_number(source.schema[spec.key].dataType)
        self.ledger.recover_interrupted(spec.source_id)
        state = self.ledger.load(spec.source_id, integer_key=whole_key)
        now = as_of or _now(self.spark)
        bound = changes.settle_bound(moment(now), self.settle_seconds)
        changed = changes.changed_since(source, spec, state.cursor, bound)
        staged = stage(
            changes.in_order(changed, spec),
            "capture",
            path=f"{self.root}/staging",
        )
        total = self._check_contract(staged, state.cursor)
        ranked = positions.with_rank(staged, "_rank")
        ranked = ranked.withColumn("_batch", batch_number(F.col("_rank"), self.batch_size))
        rows = total
        if max_batches is not None:
            ranked = ranked.where(F.col("_batch") < max_batches)
            rows = min(total, max_batches * self.batch_size)
        cycle = self.ledger.next_cycle()
        if rows == 0:
            caught_up = total == 0
            if state.mode == "full" and caught_up:
                self._end(cycle, state.cursor, 0, 0, state.last_batch_id, True)
            return CycleResult(state.mode, 0, 0, caught_up)
        events = self._events(ranked, cycle, now)
        batches = self.ledger.begin(self._batch_rows(ranked, rows, state, cycle, bound), cycle)
        newest = batches.orderBy(F.col("batch_no").desc())
        last = newest.select(
            "batch_no", "batch_id", "cursor_end_key", F.unix_micros("cursor_end_at").alias("at")
        ).first()
        try:
            self._publish(self._log_records(events), f"{self.log_path}/cycle={cycle}")
        except BaseException as exc:
            self.ledger.fail(cycle, spec.source_id, f"{type(exc).__name__}: {exc}")
            raise
        key = int(last["cursor_end_key"]) if whole_key else last["cursor_end_key"]
        caught_up = rows == total
        self._end(
            cycle,
            changes.Position(from_micros(last["at"]), key),
            rows,
            last["batch_no"] + 1,
            last["batch_id"],
            caught_up,
        )
        return CycleResult(state.mode, last["batch_no"] + 1, rows, caught_up)

    def _check_contract(self, staged: DataFrame, since: changes.Position | None) -> int:
        """The number of rows, all of which keep the contract and the order; one scan."""
        counted = changes.contract_violations(
            staged,
            self.spec,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(changes.misplaced(staged, self.spec, since)).alias("misplaced"),
        )
        found = counted.first().asDict()
        total, out_of_order = found.pop("rows"), found.pop("misplaced")
        if any(found.values()):
            raise changes.ContractError(f"rows break the source contract: {found}")
        if out_of_order:
            raise changes.ContractError("two rows share one (updated_at, key), or one is not new")
        return total

    def _end(
        self,
        cycle: int,
        cursor: changes.Position | None,
        rows: int,
        batches: int,
        last_batch_id: str | None,
        caught_up: bool,
    ) -> None:
        self.ledger.commit(
            cycle,
            self.spec.source_id,
            cursor=cursor,
            rows=rows,
            batches=batches,
            last_batch_id=last_batch_id,
            caught_up=caught_up,
        )

    def _events(self, ranked: DataFrame, cycle: int, now: datetime) -> DataFrame:
        spec = self.spec
        name = F.concat(
            F.lit(f"batch|{spec.source_id}|{cycle}|"), F.col("_batch").cast("string")
        )
        placed = ranked.withColumn(
            "_partition", log_partition(F.col(spec.key).cast("string"), self.partitions)
        )
        columns = [item for item in ranked.columns if item not in _INTERNAL]
        return to_events(
            placed.withColumn("_at", F.col(spec.updated_at)).withColumn("_key", F.col(spec.key)),
            spec,
            captured_at=moment(now),
            batch_id=ids.uuid5(EVENT_ID_NAMESPACE, name),
            keep=(*_INTERNAL, "_at", "_key"),
            payload_columns=columns,
        )

    def _batch_rows(
        self, ranked: DataFrame, rows: int, state: SyncState, cycle: int, bound: Column
    ) -> DataFrame:
        """One row per batch: counts, and what its first and last row tell.

        The boundary rows are known by their rank, so only the counts need an
        aggregation.
        """
        spec, size = self.spec, self.batch_size
        rank, version = F.col("_rank"), F.col(spec.version).cast("bigint")
        key = F.col(spec.key).cast("string")
        edge = ranked.select(
            F.col("_batch").alias("batch_no"),
            "_rank",
            F.col(spec.updated_at).cast("timestamp").alias("at"),
            key.alias("key"),
            ids.event_id(
                F.lit(spec.system), F.lit(spec.object), F.lit(spec.entity_type), key, version
            ).alias("event_id"),
        )
        first = edge.where((rank - 1) % size == 0).select(
            "batch_no", F.col("event_id").alias("first_event_id")
        )
        last = edge.where((rank % size == 0) | (rank == rows)).select(
            "batch_no",
            F.col("at").alias("cursor_end_at"),
            F.col("key").alias("cursor_end_key"),
            F.col("event_id").alias("last_event_id"),
        )
        start = edge.where(rank % size == 0).select(
            (F.col("batch_no") + 1).alias("batch_no"), F.col("at").alias("_at"),
            F.col("key").alias("_key"),
        )
        counts = ranked.groupBy(F.col("_batch").alias("batch_no")).agg(
            F.count(F.lit(1)).alias("row_count"), F.count_if(version == 1).alias("inserts")
        )
        cursor = state.cursor
        name = F.concat(F.lit(f"batch|{spec.source_id}|{cycle}|"), F.col("batch_no").cast("string"))
        first_at = F.lit(None).cast("timestamp") if cursor is None else moment(cursor.at)
        first_key = F.lit(None if cursor is None else str(cursor.key)).cast("string")
        whole = counts.join(last, "batch_no").join(first, "batch_no").join(start, "batch_no", "left")
        return whole.select(
            F.lit(spec.source_id).alias("source_id"),
            ids.uuid5(EVENT_ID_NAMESPACE, name).alias("batch_id"),
            "batch_no",
            F.lit(state.mode).alias("sync_mode"),
            F.coalesce("_at", first_at).alias("cursor_start_at"),
            F.coalesce("_key", first_key).alias("cursor_start_key"),
            "cursor_end_at",
            "cursor_end_key",
            bound.alias("upper_bound"),
            "row_count",
            "inserts",
            (F.col("row_count") - F.col("inserts")).alias("updates"),
            "first_event_id",
            "last_event_id",
            F.current_timestamp().alias("started_at"),
        )

    def _log_records(self, events: DataFrame) -> DataFrame:
        """Number the events per log partition, after what the log already holds."""
        inside = Window.partitionBy("_partition", "_block").orderBy("_rank")
        # The values are built after the shuffle, from rows as narrow as they get.
        numbered = events.withColumn("_row", F.row_number().over(inside) - 1)
        sizes = events.groupBy("_partition", "_block").agg(F.count(F.lit(1)).alias("_size"))
        before = (
            Window.partitionBy("_partition")
            .orderBy("_block")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        ends = end_offsets(self.log()).select(
            F.col("partition").alias("_partition"), F.col("end_offset").alias("_end")
        )
        # One row per log partition and range partition.
        starts = (
            sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
            .join(F.broadcast(ends), "_partition", "left")
            .select(
                "_partition",
                "_block",
                (F.col("_before") + F.coalesce("_end", F.lit(0))).alias("_start"),
            )
        )
        placed = numbered.join(F.broadcast(starts), ["_partition", "_block"]).withColumn(
            "offset", F.col("_start") + F.col("_row")
        )
        values = to_log_values(
            placed.withColumn("partition", F.col("_partition")), "partition", "offset"
        )
        return values.withColumn("topic", F.lit(self.topic)).select(*LOG_RECORD)


def _append(records: DataFrame, path: str) -> None:
    """Add the records to the Parquet log, as a folder of their own."""
    records.write.mode("error").parquet(path)
