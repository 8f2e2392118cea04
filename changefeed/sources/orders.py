"""The demo source table: orders joined with their customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.operators.envelope import SourceSpec

ORDERS_SPEC = SourceSpec(
    system="parquet",
    object="orders",
    entity_type="order",
    key="o_orderkey",
    version="row_version",
    updated_at="updated_at",
)
COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
    "o_clerk",
    "o_shippriority",
    "o_comment",
    "c_name",
    "c_mktsegment",
    "c_nationkey",
    "c_acctbal",
    "row_version",
    "updated_at",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # Files written without a zone read as timestamp_ntz; they hold UTC.
    casts = {
        field.name: F.col(field.name).cast("timestamp")
        for field in df.schema.fields
        if field.dataType.typeName() == "timestamp_ntz"
    }
    return df.withColumns(casts) if casts else df


def _clerk(number: Column) -> Column:
    return F.concat(
        F.lit("Clerk#"), F.lpad((F.lit(1) + F.pmod(number * 13, F.lit(1000))).cast("string"), 9, "0")
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source table as capture sees it: version by key, times with many ties."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
        _clerk(key).alias("o_clerk"),
        F.lit(0).cast("bigint").alias("o_shippriority"),
        F.concat(F.lit("order "), key.cast("string")).alias("o_comment"),
        "c_name",
        "c_mktsegment",
        "c_nationkey",
        F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
        (F.lit(1) + F.pmod(key, F.lit(3))).alias("row_version"),
        F.col("o_orderdate").alias("updated_at"),
    )


def seed_orders(spark: SparkSession, sf_dir: str, loaded_at: Column) -> DataFrame:
    """All rows, each version 1 and stamped with the load time."""
    return (
        order_rows(spark, sf_dir)
        .withColumn("row_version", F.lit(1).cast("bigint"))
        .withColumn("updated_at", loaded_at)
    )


def seed_if_empty(rows: DataFrame, path: str, *, force: bool = False) -> bool:
    """Write the seed unless the target holds rows; tells whether it wrote."""
    spark = rows.sparkSession
    if not force:
        from changefeed.streaming.tables import path_exists

        if path_exists(spark, path) and not spark.read.schema(rows.schema).parquet(path).isEmpty():
            return False
    rows.write.mode("overwrite").parquet(path)
    return True


def sample_keys(df: DataFrame, key: str, count: int, seed: str) -> DataFrame:
    """``count`` keys in an order that looks random and repeats for one seed."""
    mixed = F.md5(F.concat(F.lit(seed), F.lit("|"), F.col(key).cast("string")))
    return df.select(key).orderBy(mixed, key).limit(count)


def line_totals(lines: DataFrame) -> DataFrame:
    """What the lines of each order say: its status (that of all lines, or mixed) and its price."""
    status = F.when(F.min("l_linestatus") == F.max("l_linestatus"), F.min("l_linestatus")).otherwise(F.lit("P"))
    price = F.sum(F.col("l_extendedprice").cast("decimal(12,2)"))
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        status.alias("o_orderstatus"), price.cast("decimal(12,2)").alias("o_totalprice")
    )


def merge_versions(rows: DataFrame, changes: DataFrame, *, key: str, updated_at: Column) -> DataFrame:
    """``rows`` with the values of ``changes``, which holds each key at most once.

    A row gets the next version and the new time only if a value differs; rows without a
    change, and changes that say what the row says, leave it as it is.
    """
    values = [name for name in changes.columns if name != key]
    new = changes.select(key, F.struct(*values).alias("_new"))
    differs = F.lit(False)
    for name in values:
        differs = differs | ~F.col(name).eqNullSafe(F.col(f"_new.{name}"))
    differs = F.col("_new").isNotNull() & differs
    becomes = {name: F.col(f"_new.{name}") for name in values}
    becomes |= {"row_version": F.col("row_version") + 1, "updated_at": updated_at}
    return rows.join(new, key, "left").select(
        *[
            F.when(differs, becomes[name]).otherwise(F.col(name)).alias(name) if name in becomes else F.col(name)
            for name in rows.columns
        ]
    )
