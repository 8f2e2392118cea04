"""Percentiles by brackets against sorted lists; the order check without a second exchange."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from changefeed.operators import positions
from changefeed.operators.quantiles import exact_quantiles

FRACTIONS = [0.0, 0.5, 0.95, 1.0]


def expected(values, fraction):
    known = sorted(v for v in values if v is not None)
    if not known:
        return None
    at = (len(known) - 1) * fraction
    return known[math.floor(at)], known[math.ceil(at)], at - math.floor(at)


@pytest.mark.parametrize("accuracy, most", [(10_000, 1 << 20), (20, 10), (5, 0)])
def test_equal_sorted_lists(spark, accuracy, most):
    draw = random.Random(3)
    columns = {
        "spread": [draw.randrange(-(10**9), 10**9) for _ in range(3000)],
        "third": [7 if draw.random() < 0.4 else draw.randrange(50) for _ in range(3000)],
        "two": [i % 2 for i in range(3000)],
        "some": [draw.randrange(9) if i % 7 == 0 else None for i in range(3000)],
        "none": [None] * 3000,
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} long" for c in columns))
    found = exact_quantiles(df.repartition(5), FRACTIONS, accuracy=accuracy, most=most)
    for name, values in columns.items():
        for fraction in FRACTIONS:
            assert found[name, fraction] == expected(values, fraction), (name, fraction)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(5,), (9,)], "v long")
    assert exact_quantiles(df, [0.5]) == {("v", 0.5): (5, 9, 0.5)}
    assert exact_quantiles(df.limit(0), [0.5]) == {("v", 0.5): None}


def test_shared_positions_move_nothing(spark):
    df = spark.range(2_000).select((F.col("id") % 900).alias("at"), (F.col("id") % 5).alias("key"))
    ordered = positions.range_ordered(df, "at", "key", shared="_shared")
    counted = ordered.groupBy("at", "key").agg(F.count(F.lit(1)).alias("n"), F.max("_shared").alias("m"))
    assert counted.where("n <> m").isEmpty()
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1, plan
