"""Order and sequence numbers without sending all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# An offset takes 47 bits (1.4e14 records per partition), a partition the rest.
_OFFSET_BITS = 47
MAX_PARTITIONS = 1 << (63 - _OFFSET_BITS)
# Rows of one partition within 2**20 consecutive offsets form a block.
_BLOCK_BITS = 20


def log_order(partition: str = "partition", offset: str = "offset") -> Column:
    """The processing order, (partition, offset), as one number."""
    part, position = F.col(partition).cast("bigint"), F.col(offset).cast("bigint")
    fits = part.between(0, MAX_PARTITIONS - 1) & position.between(0, (1 << _OFFSET_BITS) - 1)
    packed = F.shiftleft(part, _OFFSET_BITS) + position
    return F.when(fits, packed).otherwise(
        F.raise_error(F.lit("partition or offset out of the supported range")).cast("bigint")
    )


def order_block(order: Column) -> Column:
    """Consecutive stretches of the log order; at most 2**20 records each."""
    return F.shiftright(order, _BLOCK_BITS)


def partition_spans(records: DataFrame, base: int = 0) -> DataFrame:
    """First sequence number of each partition of each topic: one row per partition.

    Every partition gets as many numbers as the offsets it spans, in the order of topic
    and partition, starting after ``base``.
    """
    spans = records.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        (F.max("offset") - F.min("offset") + 1).alias("span"),
    )
    # One row per partition (at most MAX_PARTITIONS a topic): a single task is enough.
    before = Window.orderBy("topic", "partition").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select(
        "topic",
        "partition",
        "first_offset",
        (F.lit(base) + F.coalesce(F.sum("span").over(before), F.lit(0)) + 1).alias("first_seq"),
        "span",
    )


def with_sequence(records: DataFrame, spans: DataFrame, into: str = "log_seq") -> DataFrame:
    """Number the records in the order of topic, partition and offset.

    Like an identity column the numbers are unique and ascending but may have
    gaps. They follow from the offset, so they need neither a sort nor a rank and
    are the same when a lost task runs again.
    """
    starts = spans.select(
        F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "first_offset", "first_seq"
    )
    same = F.col("topic").eqNullSafe(F.col("_topic")) & (F.col("partition") == F.col("_partition"))
    return records.join(F.broadcast(starts), same).select(
        *[F.col(name) for name in records.columns],
        (F.col("first_seq") + F.col("offset") - F.col("first_offset")).alias(into),
    )


def range_ordered(df: DataFrame, *order: str, shared: str | None = None) -> DataFrame:
    """Sort over all rows, with ``_block`` and ``_row`` telling where each one is.

    ``_block`` numbers the range partitions in order, ``_row`` the rows inside.
    They belong to this one run, so the caller writes the result before reading
    it more than once (see ``session.stage``). ``shared`` names a column for how many rows
    have a row's place in the order: they are neighbours in one range partition, so
    counting them moves and sorts nothing.
    """
    place = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*[F.col(name) for name in order]).sortWithinPartitions(*order)
    if shared is not None:
        ordered = ordered.withColumn(shared, F.count(F.lit(1)).over(Window.partitionBy(*order)))
    return (
        ordered.withColumn("_place", place)
        .withColumn("_block", F.shiftright("_place", 33).cast("int"))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_place")
    )


def with_rank(staged: DataFrame, into: str, *within: str) -> DataFrame:
    """Rank from 1 over a staged ``range_ordered`` frame.

    With ``within``, ``_row`` must number the rows of one block inside each of
    these groups. Only one number per block (and group) is summed up.
    """
    sizes = staged.groupBy("_block", *within).agg(F.count(F.lit(1)).alias("_size"))
    before = (
        Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    ).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_block", *within, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    # One row per block and group: the shuffle partitions times the log partitions.
    return staged.join(F.broadcast(starts), ["_block", *within]).withColumn(
        into, F.col("_start") + F.col("_row") + 1
    ).drop("_start")
