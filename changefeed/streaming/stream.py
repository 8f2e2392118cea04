"""The log as a stream: every micro-batch is one epoch of the tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from changefeed.operators.rules import RuleSet
from changefeed.plans.materialize import resolve_epoch
from changefeed.streaming.tables import Tables


def stream_id(batch: DataFrame, checkpoint: str) -> str:
    """The id of the stream, which Spark writes to its checkpoint when it first starts."""
    lines = batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(row["value"] for row in lines))["id"]


def materialize_stream(
    log: DataFrame,
    tables: Tables,
    rules: RuleSet,
    *,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "5 seconds",
) -> StreamingQuery:
    """Start the query. Deduplication has no time bound: what was ever logged is
    known, and the table of logged ids, not the state store, remembers it.

    Every batch is the next epoch of the tables, and its commit names the stream (the
    id that its checkpoint keeps) and the batch. If a batch fails after its tables were
    written, it runs again and replaces them; if it fails after the commit, it is skipped.
    Replays between two runs of the stream do not disturb it.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        resolve_epoch(batch, tables, rules, batch=(stream_id(batch, checkpoint), batch_id))

    writer = log.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
