"""Log scans, offsets and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.functions.text import (
    decode_headers,
    first_line,
    page_position,
    page_token,
    readable,
)
from changefeed.functions.ids import uuid_or_null
from changefeed.queries import query
from changefeed.queries.sql import with_records
from changefeed.sources import log
from changefeed.sources.feed import change_log
from changefeed.sources.orders import table


@query(
    "partition_spread",
    "SELECT CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)),1,8))::BIGINT % 6 AS INTEGER) AS partition, "
    "count(*) AS records, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders GROUP BY 1",
)
def partition_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(log.portable_partition(key.cast("string")).alias("partition"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min(key).alias("min_key"),
            F.max(key).alias("max_key"),
        )
    )


@query(
    "end_offsets",
    with_records(
        "SELECT 'changes' AS topic, part AS partition, max(off) + 1 AS end_offset, "
        "min(off) AS first_offset FROM records GROUP BY part"
    ),
)
def end_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.end_offsets(change_log(spark, sf_dir))


def _half(ends: DataFrame) -> DataFrame:
    half = F.floor(F.col("end_offset") / 2)
    return ends.withColumn("end_offset", half)


_HALF = "ends AS (SELECT part, (max(off) + 1) // 2 AS half FROM records GROUP BY part)"


@query(
    "bounded_scan",
    with_records("")
    + f", {_HALF} SELECT r.part AS partition, off AS offset, entity_key AS key "
    "FROM records r JOIN ends e ON r.part = e.part WHERE off < half",
)
def bounded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = change_log(spark, sf_dir)
    found = log.bounded(records, _half(log.end_offsets(records)))
    return found.select("partition", "offset", F.col("key").cast("string").alias("key"))


@query(
    "commit_offsets",
    with_records("")
    + f", {_HALF} SELECT 'changes' AS topic, r.part AS partition, max(off) + 1 AS committed_offset "
    "FROM records r JOIN ends e ON r.part = e.part WHERE off < half GROUP BY r.part",
)
def commit_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = change_log(spark, sf_dir)
    return log.commit_offsets(log.bounded(records, _half(log.end_offsets(records))))


_LAG = (
    with_records("")
    + """, ends AS (SELECT part, max(off) + 1 AS e, min(off) AS f FROM records GROUP BY part),
lags AS (SELECT part, CASE WHEN part % 3 <> 0 THEN e // 2 END AS c, e, f FROM ends)
"""
)


def _lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions 0, 3, 6 have no committed position."""
    ends = log.end_offsets(change_log(spark, sf_dir))
    committed = ends.where(F.col("partition") % 3 != 0).select(
        "topic", "partition", F.floor(F.col("end_offset") / 2).alias("committed_offset")
    )
    return log.consumer_lag(ends, committed)


@query(
    "consumer_lag",
    _LAG + "SELECT 'changes' AS topic, part AS partition, c AS committed_offset, e AS end_offset, "
    "e - coalesce(c, f) AS lag FROM lags",
)
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lags(spark, sf_dir)


@query(
    "total_lag",
    _LAG + "SELECT CAST(coalesce(sum(e - coalesce(c, f)), 0) AS BIGINT) AS total_lag, "
    "count(*) AS partitions FROM lags",
)
def total_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.total_lag(_lags(spark, sf_dir))


@query(
    "batches_in_epoch",
    with_records("SELECT DISTINCT batch_id FROM records WHERE bad_kind IS NULL OR bad_kind >= 2"),
)
def batches_in_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.batches_in(change_log(spark, sf_dir))


@query(
    "readable_text",
    "SELECT doc_id, replace(text, ' ', chr(65533)) || chr(65533) || '.' AS raw_value FROM documents",
)
def readable_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as bytes, blanks as NUL and one byte that is not UTF-8."""
    docs = table(spark, sf_dir, "documents")
    with_nul = F.replace(F.col("text"), F.lit(" "), F.lit("\0")).cast("binary")
    raw = F.concat(with_nul, F.unhex(F.lit("FF")), F.lit(".").cast("binary"))
    return docs.select("doc_id", readable(raw).alias("raw_value"))


@query(
    "header_decode",
    "SELECT event_id, CAST(event_id AS VARCHAR) AS id_header, event_type || chr(65533) AS type_header, "
    "CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS user_header, "
    "CASE WHEN user_id % 2 = 0 THEN 3 ELSE 2 END AS headers FROM events",
)
def header_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header bytes as text; null headers are dropped, bad bytes replaced."""
    user = F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string").cast("binary"))
    raw = F.create_map(
        F.lit("id"), F.col("event_id").cast("string").cast("binary"),
        F.lit("type"), F.concat(F.col("event_type").cast("binary"), F.unhex(F.lit("C3"))),
        F.lit("user"), user,
    )
    rows = table(spark, sf_dir, "events").select("event_id", decode_headers(raw).alias("h"))
    return rows.select(
        "event_id",
        F.try_element_at("h", F.lit("id")).alias("id_header"),
        F.try_element_at("h", F.lit("type")).alias("type_header"),
        F.try_element_at("h", F.lit("user")).alias("user_header"),
        F.size("h").alias("headers"),
    )


@query(
    "correlation_ids",
    with_records(
        "SELECT part AS partition, off AS offset, entity_key, "
        "CASE WHEN bad_kind >= 2 THEN event_id END AS event_id, "
        "CASE WHEN bad_kind >= 2 THEN batch_id END AS batch_id "
        "FROM records WHERE bad_kind IS NOT NULL"
    ),
)
def correlation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What headers and key still tell about records that are not envelopes."""
    from changefeed.queries.tables import examined

    broken = examined(spark, sf_dir).where(~F.col("is_event"))
    return broken.select("partition", "offset", "entity_key", "event_id", "batch_id")


@query(
    "page_token",
    """SELECT event_id, translate(to_base64(encode('{"before": ' || event_id || '}')), '+/', '-_') AS token,
       event_id AS position FROM events""",
)
def page_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", page_token(F.col("event_id")).alias("token")
    )
    return rows.select("event_id", "token", page_position(F.col("token")).alias("position"))


@query(
    "error_text",
    "SELECT doc_id, text AS error, split_part(text, chr(10), 1) AS first_line FROM documents",
)
def error_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors as the ledger keeps them, and the line that is shown of them."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("text").alias("error"),
        first_line(F.col("text")).alias("first_line"),
    )


@query(
    "uuid_check",
    "SELECT event_id, CASE WHEN user_id % 3 <> 1 THEN lower(u) END AS parsed FROM ("
    "SELECT event_id, user_id, upper(substr(m,1,8) || '-' || substr(m,9,4) || '-' || substr(m,13,4) || '-' || "
    "substr(m,17,4) || '-' || substr(m,21,12)) AS u FROM (SELECT *, md5(CAST(event_id AS VARCHAR)) AS m FROM events))",
)
def uuid_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in upper case or without hyphens are the same ids; a cut one is none."""
    m = F.md5(F.col("event_id").cast("string"))
    parts = [F.substring(m, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    text = F.upper(F.concat_ws("-", *parts))
    shown = (
        F.when(F.col("user_id") % 3 == 0, text)
        .when(F.col("user_id") % 3 == 1, F.substring(text, 1, 35))
        .otherwise(F.replace(text, F.lit("-"), F.lit("")))
    )
    return table(spark, sf_dir, "events").select("event_id", uuid_or_null(shown).alias("parsed"))
