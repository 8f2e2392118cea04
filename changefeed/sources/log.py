"""The change log: partitioned, append-only records with offsets.

The default log is a Parquet table with the columns of a Kafka source, so the
same jobs read either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.functions.text import decode_headers
from changefeed.schemas import LOG_RECORD, ddl

LOG_PARTITIONS = 6


def log_partition(entity_key: Column, partitions: int = LOG_PARTITIONS) -> Column:
    """All versions of an entity go to one partition and keep their order."""
    return F.pmod(F.xxhash64(entity_key), F.lit(partitions)).cast("int")


def portable_partition(entity_key: Column, partitions: int = LOG_PARTITIONS) -> Column:
    """The same idea on MD5, for producers outside Spark."""
    head = F.conv(F.substring(F.md5(entity_key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(partitions)).cast("int")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ddl(LOG_RECORD)).parquet(path).select(*LOG_RECORD)


def stream_log(spark: SparkSession, path: str, *, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ddl(LOG_RECORD))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(*LOG_RECORD)


def from_kafka(records: DataFrame) -> DataFrame:
    """A Kafka source read with ``includeHeaders`` in the shape of the log."""
    raw = F.map_from_entries(
        F.transform(
            F.array_distinct(F.transform("headers", lambda item: item["key"])),
            lambda name: F.struct(
                name,
                # The last value of a repeated name, as a mapping would keep.
                F.element_at(
                    F.filter("headers", lambda item: item["key"] == name), -1
                )["value"],
            ),
        )
    )
    headers = F.when(F.col("headers").isNull(), F.create_map().cast("map<string,string>"))
    return records.select(
        "topic", "partition", "offset", "key", "value",
        headers.otherwise(decode_headers(raw)).alias("headers"),
    )


def to_kafka(log_values: DataFrame) -> DataFrame:
    """``key``, ``value`` and ``headers`` as the Kafka sink takes them."""
    entries = F.transform(
        F.map_entries("headers"),
        lambda item: F.struct(item["key"].alias("key"), item["value"].cast("binary").alias("value")),
    )
    return log_values.select("key", "value", entries.alias("headers"))


def end_offsets(records: DataFrame) -> DataFrame:
    """One past the last offset of every partition that has records."""
    return records.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset"), F.min("offset").alias("first_offset")
    )


def bounded(
    records: DataFrame, until: DataFrame, *, committed: DataFrame | None = None
) -> DataFrame:
    """The records below the end offsets and, if given, from the committed ones on.

    One row per partition is broadcast; the record side is filtered in place.
    """
    bounds = until.select("topic", "partition", F.col("end_offset").alias("_until"))
    if committed is None:
        starts = bounds.withColumn("_from", F.lit(0).cast("bigint"))
    else:
        start = committed.select("topic", "partition", F.col("committed_offset").alias("_from"))
        starts = bounds.join(start, ["topic", "partition"], "left").withColumn(
            "_from", F.coalesce("_from", F.lit(0).cast("bigint"))
        )
    inside = (F.col("offset") < F.col("_until")) & (F.col("offset") >= F.col("_from"))
    return (
        records.join(F.broadcast(starts), ["topic", "partition"])
        .where(inside)
        .select(*records.columns)
    )


def commit_offsets(records: DataFrame) -> DataFrame:
    """The positions to continue from after these records."""
    return records.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("committed_offset")
    )


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Records left per partition; an uncommitted partition starts at its first."""
    both = ends.join(committed, ["topic", "partition"], "left")
    start = F.coalesce("committed_offset", "first_offset")
    return both.select(
        "topic",
        "partition",
        "committed_offset",
        "end_offset",
        (F.col("end_offset") - start).alias("lag"),
    )


def total_lag(lags: DataFrame) -> DataFrame:
    return lags.agg(
        F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"),
        F.count(F.lit(1)).alias("partitions"),
    )


def batches_in(records: DataFrame) -> DataFrame:
    """The capture batches a set of records comes from, by their headers."""
    return (
        records.select(F.element_at("headers", "batch_id").alias("batch_id"))
        .where("batch_id is not null")
        .distinct()
    )


def write_kafka(log_values: DataFrame, *, servers: str, topic: str) -> None:
    """Publish to Kafka; returns when the brokers hold every record.

    Needs the Kafka connector on the class path.
    """
    (
        to_kafka(log_values)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "zstd")
        .option("topic", topic)
        .save()
    )
