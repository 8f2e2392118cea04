"""Exact percentiles of whole tables without a task that sees all values."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The sketch's rank error is one part in this many; its size per task grows with it.
ACCURACY = 10_000
# Distinct values of one percentile that may meet in a task.
MOST_IN_TASK = 1 << 20


@dataclass
class _Bracket:
    """Values among which a percentile lies: those of ``name`` from ``low`` to ``high``."""

    name: str
    fraction: float
    margin: float
    size: int = 0  # values of the column
    below: int = 0  # values under the bracket
    held: int = 0  # values in it
    inner: float = math.inf  # values in it but for its two ends
    low: int | None = None
    high: int | None = None

    @property
    def ranks(self) -> tuple[int, int]:
        """The two neighbours, from 0, between which the percentile is interpolated."""
        at = (self.size - 1) * self.fraction
        return math.floor(at), math.ceil(at)

    def holds(self) -> Column:
        value = F.col(self.name)
        return value.isNotNull() if self.low is None else value.between(self.low, self.high)

    def sketch(self, accuracy: int) -> list[Column]:
        """A lower and an upper end closer to the percentile, from a mergeable summary."""
        inside = F.when(self.holds(), F.col(self.name))
        place = (self.ranks[0] - self.below) / max(self.held - 1, 1) if self.held else self.fraction
        start, end = place - self.margin, place + self.margin
        return [
            F.min(inside) if start <= 0 else F.percentile_approx(inside, start, accuracy),
            F.max(inside) if end >= 1 else F.percentile_approx(inside, end, accuracy),
        ]


def exact_quantiles(
    values: DataFrame, fractions: list[float], *, accuracy: int = ACCURACY, most: int = MOST_IN_TASK
) -> dict[tuple[str, float], tuple[int, int, float] | None]:
    """For each column of whole numbers and each fraction the two neighbouring values and the
    weight of the upper one; None for a column without values. Nulls do not count.

    A sketch gives a bracket around each percentile, one pass counts what is below and in it
    and checks that it holds the percentile (else it is widened), and brackets with more than
    ``most`` inner values are narrowed by a sketch of their own. Only the distinct values
    of a bracket meet in a task.
    """
    brackets = [_Bracket(name, f, 2 / accuracy) for name in values.columns for f in fractions]
    sizes = values.agg(
        *[F.count(b.name) for b in brackets], *[c for b in brackets for c in b.sketch(accuracy)]
    ).first()
    ends = sizes[len(brackets) :]
    for i, b in enumerate(brackets):
        b.size = b.held = sizes[i]
    waiting = [b for b in brackets if b.size]
    while waiting:
        tried = []
        for i, b in enumerate(brackets):
            if b in waiting:
                tried.append((b, ends[2 * i], ends[2 * i + 1]))
        counts = values.agg(
            *[
                count
                for b, low, high in tried
                for count in (
                    F.count_if(F.col(b.name) < low),
                    F.count_if(F.col(b.name) <= high),
                    F.count_if((F.col(b.name) > low) & (F.col(b.name) < high)),
                )
            ]
        ).first()
        again = []
        for i, (b, low, high) in enumerate(tried):
            below, until, inner = counts[3 * i : 3 * i + 3]
            lower, upper = b.ranks
            if not below <= lower <= upper < until:
                b.margin *= 4
                again.append(b)
                continue
            b.low, b.high, b.below, b.held = low, high, below, until - below
            if most < inner < b.inner:
                again.append(b)
            b.inner = inner
        waiting = again
        if waiting:
            found = values.agg(*[c for b in waiting for c in b.sketch(accuracy)]).first()
            place = {id(b): i for i, b in enumerate(waiting)}
            ends = [
                found[2 * place[id(b)] + side] if id(b) in place else None for b in brackets for side in (0, 1)
            ]
    return _picked(values, brackets)


def _picked(values: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, float], tuple[int, int, float] | None]:
    some = [(i, b) for i, b in enumerate(brackets) if b.size]
    if not some:
        return {(b.name, b.fraction): None for b in brackets}
    inside = F.array_compact(
        F.array(*[F.when(b.holds(), F.struct(F.lit(i).alias("i"), F.col(b.name).cast("long").alias("v"))) for i, b in some])
    )
    counted = (
        values.select(F.explode_outer(inside).alias("at"))
        .where(F.col("at").isNotNull())
        .groupBy("at.i", "at.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    up_to = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)

    def value_at(rank: int) -> Column:
        """The first value with more than this many before and at it, by bracket."""
        wanted = F.lit(None)
        for i, b in some:
            wanted = F.when(F.col("i") == i, F.lit(b.ranks[rank] - b.below)).otherwise(wanted)
        return F.min(F.when(F.col("until") > wanted, F.col("v")))

    rows = (
        counted.withColumn("until", F.sum("n").over(up_to))
        .groupBy("i")
        .agg(value_at(0).alias("lower"), value_at(1).alias("upper"))
        .collect()
    )
    found = {r["i"]: (r["lower"], r["upper"]) for r in rows}
    return {
        (b.name, b.fraction): (*found[i], (b.size - 1) * b.fraction - b.ranks[0]) if b.size else None
        for i, b in enumerate(brackets)
    }
