"""Mix sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies each of its documents should have
on average, a whole part that all get and a fraction. Rounding works on the fractions: two
documents are paired and words (fraction times size) move from one to the other until one
fraction is 0 or 1; the other goes on. The direction is drawn for each pair, with chances in
inverse proportion to the two possible transfers, so the expected number of copies of both
stays. The words a source takes stay at its target all the time. It is a reduction tree:
blocks of a source's documents are reduced first, each leaves at most one fractional
document, and these are reduced again, block of blocks by block, until one is left for each
source, which is taken with the probability of its fraction.

All draws are hashes of the documents' ids, so a repeated or lost task gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import fresh, words, written

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BLOCK = 1_024
FAN_IN = 64
SEED = 17


def targets(sources: DataFrame, *, weights: Sequence[int] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """The target of each source: ``source``, ``source_size``, ``target``.

    ``sources`` has ``source`` and ``source_size``. Sources by code point, null last, take
    the weights in turn. A source stops at ``most`` times its size; with the sources in
    order of size over weight those that stop come first, so the level of the others
    follows from running sums. One row per source meets in the windows.
    """
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    full = most * F.col("source_size")
    by_limit = Window.orderBy(F.col("limit"), F.asc_nulls_last("source"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    leveled = (
        sources.withColumn("weight", weight)
        .withColumn("limit", full / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everywhere))
        .withColumn("stopped", F.coalesce(F.sum(full).over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("stopped")) / F.sum("weight").over(onward))
        .withColumn("stops", F.col("limit") <= F.col("level"))
    )
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(everywhere)
    target = F.when(F.col("stops"), full.cast("double")).otherwise(level * F.col("weight"))
    return leveled.select("source", "source_size", target.cast("double").alias("target"))


def draw(*parts: object) -> float:
    """A number in [0, 1) that the arguments fix."""
    return xxhash.xxh64_intdigest("|".join(map(str, parts)), seed=SEED) / 2**64


def reduce_pairs(ids: list, sizes: list[int], x: list[float], level: int) -> list[float]:
    """The fractions after pairwise transfers: 0 or 1 for all but at most one.

    Documents come by falling size; the open one is paired with the next until it is whole.
    """
    x = list(x)
    open_one = -1
    for j in sorted(range(len(x)), key=lambda k: (-sizes[k], str(ids[k]))):
        if not 0.0 < x[j] < 1.0:
            continue
        if open_one < 0:
            open_one = j
            continue
        i = open_one
        up = min((1 - x[i]) * sizes[i], x[j] * sizes[j])
        down = min(x[i] * sizes[i], (1 - x[j]) * sizes[j])
        moved = up if draw(level, ids[i], sizes[i], ids[j], sizes[j]) * (up + down) < down else -down
        x[i], x[j] = x[i] + moved / sizes[i], x[j] - moved / sizes[j]
        for k in (i, j):
            if x[k] < 1e-9:
                x[k] = 0.0
            elif x[k] > 1 - 1e-9:
                x[k] = 1.0
        if not 0.0 < x[i] < 1.0:
            open_one = j if 0.0 < x[j] < 1.0 else -1
    return x


def _reducer(level: int):
    def run(table: pa.Table) -> pa.Table:
        ids, sizes = table.column("__id").to_pylist(), table.column("__size").to_pylist()
        x = reduce_pairs(ids, sizes, table.column("__x").to_pylist(), level)
        at = table.schema.get_field_index("__x")
        return table.set_column(at, "__x", pa.array(x, pa.float64()))

    return run


def mix(
    documents: DataFrame,
    *,
    weights: Sequence[int] = WEIGHTS,
    most: int = MAX_COPIES,
    block: int = BLOCK,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    A null text has size 0 and takes nothing; a null source is a source of its own, the
    last. Rows that repeat are rounded each on its own. No rows, or only empty texts,
    give targets of 0. Columns of the input with these names are replaced.
    """
    ours = ("size", "source_size", "target", "copies", "taken")
    rest = documents.drop(*ours)
    sized = rest.withColumn("__size", F.size(words(F.col("text"))).cast("long"))
    return _mixed(sized, rest.columns, weights, most, block, fan_in)


def mix_ids(documents: DataFrame, **options: object) -> DataFrame:
    """The same for ``doc_id`` and ``source`` alone: texts are only read for their size."""
    sized = documents.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("__size"))
    defaults = {"weights": WEIGHTS, "most": MAX_COPIES, "block": BLOCK, "fan_in": FAN_IN}
    return _mixed(sized, ["doc_id", "source"], **(defaults | options))


def _mixed(
    sized: DataFrame, columns: list[str], weights: Sequence[int], most: int, block: int, fan_in: int
) -> DataFrame:
    sums = written(
        sized.groupBy("source").agg(F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("rows")),
        "mix-sources",
    )
    goal = targets(sums.drop("rows"), weights=weights, most=most).join(
        sums.select(F.col("source").alias("__s"), "rows"), F.col("source").eqNullSafe(F.col("__s"))
    )
    goal = goal.select(
        F.col("source").alias("__source"),
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
        F.ceil(F.col("rows") / block).alias("__blocks"),
    )
    share = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    # A hair below a whole number is that number: targets are sums of floats.
    whole = F.floor(share + 1e-9)
    rows = (
        sized.join(goal, F.col("source").eqNullSafe(F.col("__source")), "left")
        .withColumn("__id", F.col("doc_id").cast("string"))
        .withColumn("__whole", whole)
        .withColumn("__x", F.when(F.col("__size") > 0, F.greatest(share - whole, F.lit(0.0))).otherwise(0.0))
        .withColumn("__block", F.pmod(F.xxhash64("doc_id", "__size"), F.col("__blocks")))
        .drop("__source", "__blocks")
    )
    blocks = sums.agg(F.max(F.ceil(F.col("rows") / block))).first()[0] or 1
    reduced = rows.groupBy("source", "__block").applyInArrow(_reducer(0), rows.schema)
    reduced = written(reduced, "mix-0")
    is_open = (F.col("__x") > 0) & (F.col("__x") < 1)
    done, left, level = [reduced.where(~is_open)], reduced.where(is_open), 0
    while blocks > 1:
        level, blocks = level + 1, -(-blocks // fan_in)
        left = left.withColumn("__block", F.floor(F.col("__block") / fan_in))
        left = written(left.groupBy("source", "__block").applyInArrow(_reducer(level), left.schema), f"mix-{level}")
        done.append(left.where(~is_open))
        left = left.where(is_open)
    last = F.pmod(F.xxhash64(F.lit(SEED), "__id", "__size"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    done.append(left.withColumn("__x", F.when(last < F.col("__x"), 1.0).otherwise(0.0)))
    everything = done[0]
    for part in done[1:]:
        everything = everything.unionByName(part)
    copies = (F.col("__whole") + F.col("__x")).cast("long")
    return everything.select(
        *columns,
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        copies.alias("copies"),
        (copies * F.col("__size")).alias("taken"),
    )


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The documents as the mix takes them: each row as often as it has copies.

    Rounding sees ids, sources and sizes only; the texts meet their copies once, afterwards.
    Rows are known by two 64-bit hashes of all their columns; equal rows are rounded each on
    its own and their copies added. The columns are those of the input, whatever their names.
    Null and empty texts have no words and are not taken; null sources are one source.
    """
    columns = documents.columns
    one, two, taken = (fresh(columns, name) for name in ("__one", "__two", "__taken"))
    keyed = documents.withColumns({one: F.xxhash64(*columns), two: F.xxhash64(F.lit(SEED), *columns)})
    size = F.size(words(F.col("text"))).cast("long")
    sized = keyed.select(
        "doc_id", "source", size.alias("__size"), F.col(one).alias("__one"), F.col(two).alias("__two")
    )
    mixed = _mixed(sized, ["__one", "__two"], WEIGHTS, MAX_COPIES, BLOCK, FAN_IN)
    copies = mixed.groupBy(F.col("__one").alias(one), F.col("__two").alias(two)).agg(F.sum("copies").alias(taken))
    rows = keyed.join(copies.where(F.col(taken) > 0), [one, two]).dropDuplicates([one, two])
    return rows.withColumn(taken, F.explode(F.sequence(F.lit(1).cast("long"), F.col(taken)))).select(*columns)
