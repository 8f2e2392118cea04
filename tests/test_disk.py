"""What resolving leaves on the executors' disks while it runs."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from changefeed.operators.skew import attach_summary
from changefeed.session import stage


def shuffle_files(spark) -> int:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(folder.getPath()) for folder in manager.localDirs()]
    return sum(1 for folder in folders for _ in folder.rglob("shuffle_*.data"))


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    spark._jvm.System.gc()
    time.sleep(1)
    before = shuffle_files(spark)
    counted = spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 997).alias("k")).count()
    assert stage(counted, "counted", path=f"{tmp_path}/counted").count() == 997
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before


def test_rows_are_shuffled_once_for_their_summary(spark, tmp_path):
    """Whatever Spark expects of the sizes: the rows meet the summaries of frequent keys unshuffled."""
    rows = stage(
        spark.range(0, 30_000, 1, 3).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .when(F.col("id") % 100 != 1, F.col("id").cast("string"))
            .alias("key"),
            F.col("id").alias("ord"),
        ),
        "rows",
        path=f"{tmp_path}/rows",
    )
    rows = rows.unionByName(spark.range(0, 9_000).select(F.lit("hot").alias("key"), (F.col("id") + 30_000).alias("ord")))
    summary = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("ord").alias("first")
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach_summary(rows, summary, key="key", weight="copies", spread=F.col("ord"))
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        got = joined.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
    assert len(got) == 39_000
    for row in got:
        hot = row["key"] == "hot"
        assert row["first"] == (None if row["key"] is None else 0 if hot else row["ord"])
