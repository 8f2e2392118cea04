"""A change log derived from the given tables, with every kind of trouble in it.

Every order gives up to eight records: its versions, redeliveries, a tampered
copy, an unreadable record. Every customer gives one record of another entity
type. Which record has which flaw follows from the key, so that a query in
another engine can state the expected verdicts by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.functions import ids
from changefeed.operators.envelope import event_type, headers, value_json
from changefeed.schemas import EVENT_ID_NAMESPACE, SCHEMA_VERSION
from changefeed.sources.orders import table

TOPIC = "changes"
SLOTS = 8
FEED_SYSTEM, FEED_OBJECT = "parquet", "orders"
CUSTOMER_OBJECT = "customer"
ORDER_PARTITIONS = 6
CUSTOMER_PARTITIONS = 2
TASKS_PER_CORE = 4
BAD_KINDS = (
    "malformed_json",
    "missing_required_fields",
    "unsupported_schema_version",
    "non_deterministic_event_id",
    "missing_value",
    "invalid_utf8",
)


def _slots(key: Column) -> Column:
    """The records of one order: (slot, version)."""
    versions = F.lit(1) + F.pmod(key, F.lit(3))

    def slot(number: int, version: Column, condition: Column) -> Column:
        return F.when(
            condition,
            F.struct(F.lit(number).alias("slot"), version.cast("bigint").alias("version")),
        )

    def every(step: int) -> Column:
        return F.pmod(key, F.lit(step)) == 0

    one = F.lit(1)
    return F.filter(
        F.array(
            slot(0, one, F.lit(True)),
            slot(1, F.lit(2), versions >= 2),
            slot(2, F.lit(3), versions >= 3),
            slot(3, one, every(7)),  # redelivered as it was
            slot(4, one, every(83)),  # another content under the same id
            slot(5, one, every(61)),  # not a valid envelope
            slot(6, versions + 1, every(103)),  # a text with NUL
            slot(7, one, every(11)),  # captured again, an hour later
        ),
        lambda item: item.isNotNull(),
    )


def _payload(key: Column, slot: Column, version: Column) -> Column:
    def every(step: int) -> Column:
        return F.pmod(key, F.lit(step)) == 0

    last = version == F.lit(1) + F.pmod(key, F.lit(3))
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    order_date = F.col("o_orderdate").cast("date")
    label = F.concat(F.lit("v"), version.cast("string"))
    return F.to_json(
        F.struct(
            F.when(every(73) & (version == 3), key + 1).otherwise(key).alias("o_orderkey"),
            F.col("o_custkey"),
            F.when(every(89) & (slot == 0), F.lit("X"))
            .otherwise(F.col("o_orderstatus"))
            .alias("o_orderstatus"),
            F.when(every(97) & last, F.lit("-42.00"))
            .when(every(101) & (version == 1), F.lit(None).cast("string"))
            .otherwise(price)
            .alias("o_totalprice"),
            F.date_format(
                F.when(every(67) & (version == 2), F.date_add(order_date, 3650)).otherwise(
                    order_date
                ),
                "yyyy-MM-dd",
            ).alias("o_orderdate"),
            F.when(slot == 4, F.lit("tampered after publication"))
            .when(slot == 6, F.lit("bad\0comment"))
            .when(every(41), F.concat(F.repeat(F.lit("long comment "), 8), label))
            .otherwise(label)
            .alias("o_comment"),
        ),
        {"ignoreNullFields": "false"},
    )


def _hours(count: Column) -> Column:
    return F.make_dt_interval(hours=count.cast("int"))


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt to several tasks per core.

    A scan has as many tasks as its files have row groups. Here every row becomes records that
    cost far more than reading it, in the stage of the scan.
    """
    return rows.repartition(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = spread(table(spark, sf_dir, "orders")).withColumn("_r", F.explode(_slots(key)))
    rows = rows.select("*", F.col("_r.slot").alias("slot"), F.col("_r.version").alias("version"))
    occurred = F.col("o_orderdate") + _hours(F.col("version"))
    late = F.when(F.col("slot") == 7, F.lit(1)).otherwise(F.lit(0))
    captured = occurred + F.make_dt_interval(hours=late, secs=F.lit(5).cast("decimal(18,6)"))
    entity_key = key.cast("string")
    events = rows.select(
        F.lit(TOPIC).alias("topic"),
        F.pmod(key, F.lit(ORDER_PARTITIONS)).cast("int").alias("partition"),
        (
            F.floor(key / ORDER_PARTITIONS) * SLOTS
            + F.pmod(F.col("slot") * 3 + key, F.lit(SLOTS))
        ).alias("offset"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        ids.event_id(
            F.lit(FEED_SYSTEM), F.lit(FEED_OBJECT), F.lit("order"), entity_key, F.col("version")
        ).alias("event_id"),
        event_type(F.col("version")).alias("event_type"),
        F.struct(F.lit(FEED_SYSTEM).alias("system"), F.lit(FEED_OBJECT).alias("object")).alias(
            "source"
        ),
        F.lit("order").alias("entity_type"),
        entity_key.alias("entity_key"),
        F.col("version").alias("entity_version"),
        occurred.alias("occurred_at"),
        captured.alias("captured_at"),
        ids.uuid5(
            EVENT_ID_NAMESPACE, F.concat(F.lit("batch|"), F.floor(key / 1000).cast("string"))
        ).alias("batch_id"),
        _payload(key, F.col("slot"), F.col("version")).alias("payload"),
        "slot",
        F.pmod(F.floor(key / 61), F.lit(len(BAD_KINDS))).alias("kind"),
    )
    return events


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    moment = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + _hours(F.pmod(key, F.lit(24)))
    payload = F.to_json(
        F.struct(
            "c_custkey",
            "c_name",
            "c_nationkey",
            F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("c_acctbal"),
            "c_mktsegment",
        )
    )
    source = (F.lit(FEED_SYSTEM), F.lit(CUSTOMER_OBJECT))
    return spread(table(spark, sf_dir, "customer")).select(
        F.lit(TOPIC).alias("topic"),
        (F.lit(ORDER_PARTITIONS) + F.pmod(key, F.lit(CUSTOMER_PARTITIONS)))
        .cast("int")
        .alias("partition"),
        F.floor(key / CUSTOMER_PARTITIONS).alias("offset"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        ids.event_id(*source, F.lit("customer"), key.cast("string"), F.lit(1)).alias("event_id"),
        F.lit("insert").alias("event_type"),
        F.struct(source[0].alias("system"), source[1].alias("object")).alias("source"),
        F.lit("customer").alias("entity_type"),
        key.cast("string").alias("entity_key"),
        F.lit(1).cast("bigint").alias("entity_version"),
        moment.alias("occurred_at"),
        (moment + F.make_dt_interval(secs=F.lit(5).cast("decimal(18,6)"))).alias("captured_at"),
        ids.uuid5(EVENT_ID_NAMESPACE, F.lit("batch|customer")).alias("batch_id"),
        payload.alias("payload"),
    )


def _records(events: DataFrame, value: Column, header_map: Column) -> DataFrame:
    return events.select(
        "topic",
        "partition",
        "offset",
        F.col("entity_key").cast("binary").alias("key"),
        value.alias("value"),
        header_map.alias("headers"),
    )


def _order_value() -> Column:
    good = value_json().cast("binary")
    head = F.to_json(
        F.struct(F.lit(SCHEMA_VERSION).alias("schema_version"), F.col("event_type"))
    )
    # The first two kinds carry nothing of the event but its key.
    broken = (
        F.when(F.col("kind") == 0, F.lit('{"event_id": "not closed').cast("binary"))
        .when(F.col("kind") == 1, head.cast("binary"))
        .when(
            F.col("kind") == 2,
            F.replace(value_json(), F.lit('"schema_version":1,'), F.lit('"schema_version":2,')).cast(
                "binary"
            ),
        )
        .when(
            F.col("kind") == 3,
            F.replace(
                value_json(),
                F.col("event_id"),
                ids.uuid5(EVENT_ID_NAMESPACE, F.concat(F.lit("other|"), F.col("event_id"))),
            ).cast("binary"),
        )
        .when(F.col("kind") == 4, F.lit(None).cast("binary"))
        .otherwise(F.unhex(F.lit("FFFE7B7D")))
    )
    return F.when(F.col("slot") == 5, broken).otherwise(good)


def _order_headers() -> Column:
    bare = F.create_map().cast("map<string,string>")
    return F.when((F.col("slot") == 5) & (F.col("kind") < 2), bare).otherwise(headers())


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records, shaped as the log."""
    orders = _records(order_events(spark, sf_dir), _order_value(), _order_headers())
    customers = _records(
        customer_events(spark, sf_dir), value_json().cast("binary"), headers()
    )
    return orders.unionByName(customers)
