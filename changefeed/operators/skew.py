"""Joins and running aggregates that hold when one key owns much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more rows than this has its rows dealt out.
HEAVY_ROWS = 10_000


def attach_summary(
    rows: DataFrame, summary: DataFrame, *, key: str, weight: str, spread: Column
) -> DataFrame:
    """Left join ``rows`` to the one ``summary`` row of their text key.

    Keys with more than ``HEAVY_ROWS`` rows are joined apart, by a broadcast: there is at
    most one for that many rows. Their rows, and those without a key, enter the other join
    under a key of their own made from ``spread``, so no task receives all copies of one
    key there. So the rows are shuffled once.
    """
    values = [name for name in summary.columns if name not in (key, weight)]
    # Both sides below use every column and only non-null keys: then their plans
    # are equal, and Spark computes the summary once and reuses its shuffle.
    summary = summary.where(F.col(key).isNotNull())
    packed = F.struct(weight, *values)
    heavy = summary.where(F.col(weight) > HEAVY_ROWS).select(F.col(key), packed.alias("_heavy"))
    plain = summary.select(F.col(key).alias("_key"), packed.alias("_plain"))
    dealt = F.concat(F.lit("#"), spread.cast("string"))
    joined = (
        rows.join(F.broadcast(heavy), key, "left")
        .withColumn(
            "_key",
            F.when(F.col("_heavy").isNotNull() | F.col(key).isNull(), dealt).otherwise(F.col(key)),
        )
        .join(plain, "_key", "left")
    )
    found = F.coalesce("_heavy", "_plain")
    return joined.select(
        *[F.col(name) for name in rows.columns], *[found[name].alias(name) for name in values]
    )


def max_before(
    rows: DataFrame, *, keys: list[str], order: str, block: Column, value: str, into: str
) -> DataFrame:
    """``into`` = the largest ``value`` among the earlier rows of the same keys.

    A plain running window puts every row of a key into one task. Here the rows of
    every key are first cut into blocks of the order; ``block`` must grow with
    ``order`` and bound the rows of one block. Each block runs by itself and gets
    the maximum of the blocks before it, computed from one row per block.
    """
    flagged = rows.withColumn("_block", block)
    per_block = flagged.groupBy(*keys, "_block").agg(F.max(value).alias("_block_max"))
    earlier_blocks = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = per_block.select(
        *keys, "_block", F.max("_block_max").over(earlier_blocks).alias("_carried")
    )
    earlier_rows = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside = flagged.withColumn("_inside", F.max(value).over(earlier_rows))
    return inside.join(carried, [*keys, "_block"], "left").select(
        *[F.col(name) for name in rows.columns],
        F.greatest("_inside", "_carried").alias(into),
    )
