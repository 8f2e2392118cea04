"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import written


def components(edges: DataFrame, *, most_rounds: int = 200) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with.

    ``edges`` has long columns ``a`` and ``b``; only nodes with edges come back. In a round
    every node takes the smallest label among its neighbours, then the label of its label,
    so labels travel twice as far with each round. Rounds are written copies.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a <> b").distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label"))
    labels = written(labels, "labels")
    for _ in range(most_rounds):
        seen = labels.select(F.col("node").alias("b"), "label")
        lowest = both.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        hooked = labels.join(lowest, "node").select("node", F.least("label", "low").alias("new"), "label")
        onward = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        moved = hooked.join(onward, "new").select("node", F.least("new", "next").alias("to"), "label")
        moved = written(moved, "labels")
        done = moved.where(F.col("to") != F.col("label")).isEmpty()
        labels = moved.select("node", F.col("to").alias("label"))
        if done:
            return labels
    raise RuntimeError(f"no end after {most_rounds} rounds")
