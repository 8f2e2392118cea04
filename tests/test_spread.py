"""The feed's work is dealt to tasks, whatever the files are, and decoded once for all tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changefeed.operators import resolve
from changefeed.queries import QUERIES, load_all
from changefeed.sources.feed import change_log

load_all()


@pytest.fixture()
def one_file(spark, tmp_path):
    """Orders and customers in one row group each."""
    key = F.col("id")
    orders = spark.range(0, 400, 1, 1).select(
        key.alias("o_orderkey"),
        F.pmod(key, F.lit(20)).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit(12.5).alias("o_totalprice"),
        F.timestamp_seconds(1_700_000_000 + key).alias("o_orderdate"),
    )
    customers = spark.range(0, 20, 1, 1).select(
        key.alias("c_custkey"),
        F.lit("c").alias("c_name"),
        F.lit(1).alias("c_nationkey"),
        F.lit(1.5).alias("c_acctbal"),
        F.lit("m").alias("c_mktsegment"),
    )
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_records_of_one_row_group_come_from_many_tasks(spark, one_file):
    orders = change_log(spark, one_file).where("partition < 6")
    tasks = orders.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) >= spark.sparkContext.defaultParallelism
    assert max(row["count"] for row in tasks) < sum(row["count"] for row in tasks) / 2


def test_the_feed_is_decoded_once(spark, one_file, monkeypatch):
    calls, examine = [], resolve.examine

    def counted(records, rules):
        calls.append(rules)
        return examine(records, rules)

    monkeypatch.setattr(resolve, "examine", counted)
    rows = QUERIES["known_fingerprints"](spark, one_file)
    assert rows.count() > 0
    assert len(calls) == 1
