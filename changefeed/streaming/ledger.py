"""Watermark and batch ledger of the capture side."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.functions.times import from_micros, moment
from changefeed.schemas import (
    BATCHES,
    COMMITTED,
    CYCLES,
    FAILED,
    INTERRUPTED,
    RUNNING,
    ddl,
)
from changefeed.sources.changes import Position
from changefeed.streaming.tables import numbered_folders, path_exists


class LedgerError(RuntimeError):
    """A cycle that is not running cannot be committed."""


@dataclass(frozen=True)
class SyncState:
    source_id: str
    cursor: Position | None
    initial_sync_completed_at: datetime | None
    last_batch_id: str | None

    @property
    def mode(self) -> str:
        return "full" if self.initial_sync_completed_at is None else "incremental"


class Ledger:
    """Two tables under ``root``: the batches of every cycle and the cycles' ends.

    A cycle's end is one row in one file, so it appears as a whole or not at all;
    the watermark is part of it and thus moves only with the commit.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, table: str, columns: dict[str, str]) -> DataFrame:
        schema = ddl(columns, {"cycle": "bigint"})
        path = f"{self.root}/{table}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def cycles(self) -> DataFrame:
        return self._read("cycles", CYCLES)

    def batches(self) -> DataFrame:
        """Every batch with the status its cycle gave it."""
        ends = self.cycles().select(
            "cycle", "status", "finished_at", "error", F.col("source_id").alias("_source")
        )
        rows = self._read("batches", BATCHES)
        # One row per cycle.
        joined = rows.join(F.broadcast(ends), "cycle", "left")
        return joined.withColumn("status", F.coalesce("status", F.lit(RUNNING))).drop("_source")

    def _numbers(self, table: str) -> set[int]:
        return numbered_folders(self.spark, f"{self.root}/{table}", "cycle")

    def next_cycle(self) -> int:
        return max(self._numbers("batches") | self._numbers("cycles"), default=-1) + 1

    def load(self, source_id: str, *, integer_key: bool) -> SyncState:
        if not self._numbers("cycles"):
            return SyncState(source_id, None, None, None)
        mine = self.cycles().where(
            (F.col("source_id") == source_id) & (F.col("status") == COMMITTED)
        )
        position = F.struct(
            "cycle", F.unix_micros("cursor_at").alias("at"), "cursor_key", "last_batch_id"
        )
        row = mine.agg(
            F.max(F.when(F.col("cursor_at").isNotNull(), position)).alias("moved"),
            F.min(F.when(F.col("caught_up"), F.unix_micros("finished_at"))).alias("done"),
        ).first()
        moved, done = row["moved"], from_micros(row["done"])
        if moved is None:
            return SyncState(source_id, None, done, None)
        if moved["cursor_key"] is None:
            raise LedgerError(f"cycle {moved['cycle']} holds half a cursor")
        key = int(moved["cursor_key"]) if integer_key else moved["cursor_key"]
        cursor = Position(from_micros(moved["at"]), key)
        return SyncState(source_id, cursor, done, moved["last_batch_id"])

    def begin(self, batches: DataFrame, cycle: int) -> DataFrame:
        target = f"{self.root}/batches/cycle={cycle}"
        batches.select(*BATCHES).write.mode("error").parquet(target)
        return self.spark.read.schema(ddl(BATCHES)).parquet(target)

    def _end(self, cycle: int, row: DataFrame) -> None:
        target = f"{self.root}/cycles/cycle={cycle}"
        if path_exists(self.spark, target):
            raise LedgerError(f"cycle {cycle} is not running")
        shaped = row.select(*[F.col(name).cast(kind) for name, kind in CYCLES.items()])
        shaped.coalesce(1).write.mode("error").parquet(target)

    def commit(
        self,
        cycle: int,
        source_id: str,
        *,
        cursor: Position | None,
        rows: int,
        batches: int,
        last_batch_id: str | None,
        caught_up: bool,
    ) -> None:
        if rows and cursor is None:
            raise LedgerError("a cycle with rows needs a cursor")
        self._end(
            cycle,
            self.spark.range(1).select(
                F.lit(source_id).alias("source_id"),
                F.lit(COMMITTED).alias("status"),
                (F.lit(None) if cursor is None else moment(cursor.at)).alias("cursor_at"),
                F.lit(None if cursor is None else str(cursor.key)).alias("cursor_key"),
                F.lit(rows).alias("rows"),
                F.lit(batches).alias("batches"),
                F.lit(last_batch_id).alias("last_batch_id"),
                F.lit(caught_up).alias("caught_up"),
                F.current_timestamp().alias("finished_at"),
                F.lit(None).alias("error"),
            ),
        )

    def fail(self, cycle: int, source_id: str, error: str) -> None:
        self._end(
            cycle,
            self.spark.range(1).select(
                F.lit(source_id).alias("source_id"),
                F.lit(FAILED).alias("status"),
                *[
                    F.lit(None).alias(name)
                    for name in ("cursor_at", "cursor_key", "rows", "batches", "last_batch_id")
                ],
                F.lit(False).alias("caught_up"),
                F.current_timestamp().alias("finished_at"),
                F.lit(error).alias("error"),
            ),
        )

    def recover_interrupted(self, source_id: str) -> int:
        """Close the cycles of this source that a crash left running; their events may
        be published but the watermark never moved. Other sources may be running."""
        unfinished = self._numbers("batches") - self._numbers("cycles")
        if not unfinished:
            return 0
        own = self._read("batches", BATCHES).where(
            F.col("cycle").isin(*unfinished) & (F.col("source_id") == source_id)
        )
        open_cycles = {row["cycle"] for row in own.select("cycle").distinct().collect()}
        for cycle in sorted(open_cycles):
            self.fail(cycle, source_id, INTERRUPTED)
        return len(open_cycles)
