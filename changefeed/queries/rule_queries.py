"""Every kind of quality check over the whole feed or table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.operators.rules import RuleSet, load_rules, parse_rules
from changefeed.queries import query
from changefeed.queries.sql import RECORDS
from changefeed.sources.feed import order_events
from changefeed.sources.orders import table


def _rules(check: str, field: str, entity: str = "order", **options: Any) -> RuleSet:
    rule = {
        "name": f"rule_{check}", "description": check, "field": field, "severity": "reject",
        "check": check, **options,
    }
    return parse_rules({"version": 1, "entities": {entity: [rule]}})


def _findings(events: DataFrame, rules: RuleSet, *keys: str) -> DataFrame:
    hits = _hits(events, rules, *keys)
    return hits.select(*keys, F.col("v.message").alias("message"))


def _hits(events: DataFrame, rules: RuleSet, *keys: str) -> DataFrame:
    found = rules.evaluate(events.withColumn("payload_variant", F.parse_json("payload")))
    # A plain explode would infer a filter on the array and push it below the
    # projections, computing every rule twice.
    hits = found.select(*keys, F.explode_outer("violations").alias("v"))
    return hits.where(F.col("v").isNotNull())


def _orders(spark: SparkSession, sf_dir: str, check: str, field: str, **options: Any) -> DataFrame:
    events = order_events(spark, sf_dir)
    return _findings(events, _rules(check, field, **options), "partition", "offset")


def _sql(message: str, where: str) -> str:
    return (
        f"WITH {RECORDS} SELECT part AS partition, off AS offset, {message} AS message "
        f"FROM order_values WHERE {where}"
    )


@query("rule_not_null", _sql("'value is null'", "p_price IS NULL"))
def rule_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "not_null", "o_totalprice")


@query("rule_missing", _sql("'field is missing'", "TRUE"))
def rule_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "not_null", "o_clerk")


@query(
    "rule_min",
    _sql("'value ' || p_price || ' is below the minimum 25000'", "CAST(p_price AS DOUBLE) < 25000"),
)
def rule_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "min", "o_totalprice", value=25000)


@query(
    "rule_max",
    _sql(
        "'value ' || p_price || ' is above the maximum 400000.5'",
        "CAST(p_price AS DECIMAL(18,2)) > 400000.5",
    ),
)
def rule_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "max", "o_totalprice", value=400000.5)


@query("rule_numeric", _sql("'value ''' || p_status || ''' is not numeric'", "TRUE"))
def rule_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "min", "o_orderstatus", value=0)


@query(
    "rule_allowed_values",
    _sql("'value ''' || p_status || ''' is not one of [''O'', ''F'']'", "p_status NOT IN ('O','F')"),
)
def rule_allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "allowed_values", "o_orderstatus", values=["O", "F"])


@query(
    "rule_pattern",
    _sql(
        "'value ''' || p_comment || ''' does not match ''v[12]'''",
        "slot <> 6 AND NOT regexp_full_match(p_comment, 'v[12]')",
    )
    + " UNION ALL "
    + "SELECT part, off, 'value ''bad\\x00comment'' does not match ''v[12]''' "
    "FROM order_values WHERE slot = 6",
)
def rule_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "pattern", "o_comment", regex="v[12]")


@query(
    "rule_max_length",
    _sql(
        "'length ' || CASE WHEN slot = 6 THEN 11 ELSE length(p_comment) END || ' exceeds 10'",
        "slot = 6 OR length(p_comment) > 10",
    ),
)
def rule_max_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "max_length", "o_comment", value=10)


@query(
    "rule_matches_key",
    _sql(
        "'value ' || p_key || ' does not match entity_key ''' || entity_key || ''''",
        "CAST(p_key AS VARCHAR) <> entity_key",
    ),
)
def rule_matches_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "matches_entity_key", "o_orderkey")


@query(
    "rule_not_after_capture",
    _sql(
        "p_date || ' is later than the capture time ' || strftime(captured, '%Y-%m-%dT%H:%M:%S+00:00')",
        "p_date > CAST(captured AS DATE)",
    ),
)
def rule_not_after_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "not_after_captured_at", "o_orderdate")


@query(
    "rule_integer_payload",
    "SELECT event_id, 'value ' || k || ' is below the minimum 50' AS message FROM ("
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) WHERE k < 50",
)
def rule_integer_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A numeric check on JSON that came with the table."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.lit("event").alias("entity_type"),
        F.col("event_id").cast("string").alias("entity_key"),
        F.col("ts").alias("captured_at"),
        F.col("props").alias("payload"),
    )
    return _findings(events, _rules("min", "k", "event", value=50), "event_id")


_ALL = f"""WITH {RECORDS}, found AS (
  SELECT part, off, unnest(rejects) AS rule, 'reject' AS severity FROM order_records
  UNION ALL SELECT part, off, unnest(warns), 'warn' FROM order_records)
"""


def _shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(order_events(spark, sf_dir), load_rules(), "partition", "offset")


@query(
    "rule_report",
    _ALL + "SELECT part AS partition, off AS offset, rule, severity FROM found",
)
def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shipped(spark, sf_dir).select("partition", "offset", "v.rule", "v.severity")


@query("order_rules", _ALL + "SELECT rule, severity, count(*) AS records FROM found GROUP BY ALL")
def order_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _shipped(spark, sf_dir).groupBy("v.rule", "v.severity")
    return hits.agg(F.count(F.lit(1)).alias("records"))
