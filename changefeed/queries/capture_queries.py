"""Source scans, events and the batch ledger."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.functions import ids
from changefeed.functions.payload import payload_json
from changefeed.functions.times import moment
from changefeed.operators import positions
from changefeed.operators.envelope import to_events
from changefeed.plans.capture import Capture, batch_number, batch_summary
from changefeed.plans.reads import recent_batches, watermarks
from changefeed.queries import query
from changefeed.queries.sql import event_uuid
from changefeed.schemas import EVENT_ID_NAMESPACE
from changefeed.queries.tables import once
from changefeed.session import stage
from changefeed.sources import changes, orders
from changefeed.sources.orders import ORDERS_SPEC as SPEC

# The cursor lies inside a tie: several orders share the date.
CURSOR = changes.Position(datetime(1996, 5, 28, tzinfo=UTC), 7000)
BOUND = datetime(1999, 1, 1, tzinfo=UTC)
LOADED = datetime(2024, 6, 1, 12, tzinfo=UTC)
SETTLE = 86_400
BATCH = 2_000

_SOURCE = """
source AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
         o_orderpriority, 'Clerk#' || lpad(CAST(1 + o_orderkey * 13 % 1000 AS VARCHAR), 9, '0') AS o_clerk,
         0 AS o_shippriority, 'order ' || o_orderkey AS o_comment, c_name, c_mktsegment, c_nationkey,
         CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, 1 + o_orderkey % 3 AS row_version,
         o_orderdate AS updated_at
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""
_AFTER = (
    "updated_at <= TIMESTAMP '1999-01-01' AND updated_at >= TIMESTAMP '1996-05-28' "
    "AND (updated_at > TIMESTAMP '1996-05-28' OR o_orderkey > 7000)"
)


def _micros(name: str) -> str:
    return f"epoch_us({name})"


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_rows(spark, sf_dir)


def _us(name: str) -> F.Column:
    return F.unix_micros(name).alias(name)


@query(
    "keyset_scan",
    f"WITH {_SOURCE} SELECT o_orderkey, row_version, epoch_us(updated_at) AS updated_at "
    f"FROM source WHERE {_AFTER}",
)
def keyset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.changed_since(_source(spark, sf_dir), SPEC, CURSOR, moment(BOUND))
    return rows.select("o_orderkey", "row_version", _us("updated_at"))


@query(
    "keyset_page",
    f"WITH {_SOURCE} SELECT o_orderkey, row_version, epoch_us(updated_at) AS updated_at "
    f"FROM source WHERE {_AFTER} ORDER BY updated_at, o_orderkey LIMIT 250",
)
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = changes.fetch_changes(_source(spark, sf_dir), SPEC, CURSOR, moment(BOUND), 250)
    return page.select("o_orderkey", "row_version", _us("updated_at"))


@query(
    "settle_window",
    "SELECT o_orderkey, epoch_us(o_orderdate) AS updated_at FROM orders "
    "WHERE o_orderdate <= TIMESTAMP '1999-01-01' - INTERVAL 86400 SECOND",
)
def settle_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders.table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "updated_at")
    found = changes.settled(rows, SPEC, moment(BOUND), SETTLE)
    return found.select("o_orderkey", _us("updated_at"))


@query(
    "contract_violations",
    "SELECT count(*) FILTER (WHERE k IS NULL) AS null_keys, "
    "count(*) FILTER (WHERE v IS NULL OR v < 1) AS bad_versions, "
    "count(*) FILTER (WHERE t IS NULL) AS null_times FROM (SELECT "
    "CASE WHEN o_orderkey % 17 <> 0 THEN o_orderkey END AS k, o_orderkey % 5 AS v, "
    "CASE WHEN o_orderkey % 19 <> 0 THEN o_orderdate END AS t FROM orders)",
)
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    broken = orders.table(spark, sf_dir, "orders").select(
        F.when(key % 17 != 0, key).alias("o_orderkey"),
        (key % 5).alias("row_version"),
        F.when(key % 19 != 0, F.col("o_orderdate")).alias("updated_at"),
    )
    changes.check_columns(broken, SPEC)
    return changes.contract_violations(broken, SPEC)


def _flat(rows: DataFrame) -> DataFrame:
    """Decimals, dates and times as text, so that any engine shows them alike."""
    text = {name: F.col(name).cast("string") for name in ("o_totalprice", "o_orderdate", "c_acctbal")}
    return rows.withColumns(text).withColumn("updated_at", F.unix_micros("updated_at"))


_FLAT = (
    "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, "
    "CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority, o_clerk, o_shippriority, "
    "o_comment, c_name, c_mktsegment, c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal"
)


@query(
    "seed_orders",
    f"WITH {_SOURCE} SELECT {_FLAT}, 1 AS row_version, "
    "epoch_us(TIMESTAMP '2024-06-01 12:00:00') AS updated_at FROM source",
)
def seed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(orders.seed_orders(spark, sf_dir, moment(LOADED)))


_PAYLOAD = (
    """'{"c_acctbal":"' || c_acctbal || '","c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name
  || '","c_nationkey":' || c_nationkey || ',"o_clerk":"' || o_clerk || '","o_comment":"' || o_comment
  || '","o_custkey":' || o_custkey || ',"o_orderdate":"' || o_orderdate || '","o_orderkey":' || o_orderkey
  || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus
  || '","o_shippriority":' || o_shippriority || ',"o_totalprice":"' || o_totalprice
  || '","row_version":' || row_version || ',"updated_at":"' || strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00') || '"}'"""
)


@query("payload", f"WITH {_SOURCE} SELECT o_orderkey, {_PAYLOAD} AS payload FROM source")
def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload objects with their members in name order."""
    rows = _source(spark, sf_dir)
    text = rows.select("o_orderkey", payload_json(rows).alias("payload"))
    return text.select("o_orderkey", F.to_json(F.parse_json("payload")).alias("payload"))


@query(
    "payload_types",
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type
       || '","ratio":' || CASE WHEN user_id % 4 = 0 THEN '"nan"' WHEN user_id % 4 = 1 THEN '"inf"'
                               WHEN user_id % 4 = 2 THEN '"-inf"' ELSE 'null' END
       || ',"seen":' || CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END
       || ',"tag":"' || to_base64(encode(event_type)) || '","ts":"'
       || strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE
          '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') END || '+00:00"}' AS payload FROM events""",
)
def payload_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-finite floats, booleans, bytes, microseconds and nulls in a payload."""
    user = F.col("user_id") % 4
    rows = orders.table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.when(user == 0, F.lit(float("nan")))
        .when(user == 1, F.lit(float("inf")))
        .when(user == 2, F.lit(float("-inf")))
        .alias("ratio"),
        (F.col("user_id") % 2 == 0).alias("seen"),
        F.col("event_type").cast("binary").alias("tag"),
        "ts",
    )
    text = rows.select("event_id", payload_json(rows).alias("payload"))
    return text.select("event_id", F.to_json(F.parse_json("payload")).alias("payload"))


_EVENT_ID = event_uuid("'parquet|orders|order|' || o_orderkey || '|' || row_version")


@query(
    "change_events",
    f"WITH {_SOURCE} SELECT {_EVENT_ID} AS event_id, "
    "CASE WHEN row_version = 1 THEN 'insert' ELSE 'update' END AS event_type, "
    "'order' AS entity_type, CAST(o_orderkey AS VARCHAR) AS entity_key, row_version AS entity_version, "
    "epoch_us(updated_at) AS occurred_at, epoch_us(TIMESTAMP '2024-06-01 12:00:00') AS captured_at, "
    f"{event_uuid("'batch|' || (o_orderkey // 1000)")} AS batch_id, "
    f"'parquet' AS system, 'orders' AS object, {_PAYLOAD} AS payload FROM source",
)
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = F.concat(F.lit("batch|"), F.floor(F.col("o_orderkey") / 1000).cast("string"))
    events = to_events(
        _source(spark, sf_dir),
        SPEC,
        captured_at=moment(LOADED),
        batch_id=ids.uuid5(EVENT_ID_NAMESPACE, batch),
    )
    return events.select(
        "event_id", "event_type", "entity_type", "entity_key", "entity_version",
        _us("occurred_at"), _us("captured_at"), "batch_id",
        F.col("source.system").alias("system"), F.col("source.object").alias("object"),
        F.to_json(F.parse_json("payload")).alias("payload"),
    )


_RANKED = f"""{_SOURCE},
ranked AS (SELECT *, row_number() OVER (ORDER BY updated_at, o_orderkey) AS position FROM source),
sliced AS (SELECT *, (position - 1) // {BATCH} AS batch_no FROM ranked)
"""


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _source(spark, sf_dir).select("o_orderkey", "row_version", "updated_at")
    staged = stage(positions.range_ordered(rows, "updated_at", "o_orderkey"), "slices")
    ranked = positions.with_rank(staged, "position")
    return ranked.withColumn("batch_no", batch_number(F.col("position"), BATCH))


@query("batch_slices", f"WITH {_RANKED} SELECT o_orderkey, position, batch_no FROM sliced")
def batch_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sliced(spark, sf_dir).select("o_orderkey", "position", "batch_no")


@query(
    "batch_summary",
    f"WITH {_RANKED}, ev AS (SELECT *, {_EVENT_ID} AS event_id FROM sliced) "
    "SELECT batch_no, count(*) AS row_count, count(*) FILTER (WHERE row_version = 1) AS inserts, "
    "count(*) FILTER (WHERE row_version <> 1) AS updates, "
    "epoch_us(arg_max(updated_at, position)) AS cursor_end_at, "
    "arg_max(o_orderkey, position) AS cursor_end_key, arg_min(event_id, position) AS first_event_id, "
    "arg_max(event_id, position) AS last_event_id FROM ev GROUP BY batch_no",
)
def batch_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = to_events(
        _sliced(spark, sf_dir),
        SPEC,
        captured_at=moment(LOADED),
        batch_id=F.lit(None).cast("string"),
        keep=("batch_no", "o_orderkey"),
        payload_columns=["o_orderkey"],
    )
    summary = batch_summary(events, "batch_no", at="occurred_at", key="o_orderkey")
    return summary.withColumn("cursor_end_at", F.unix_micros("cursor_end_at"))


@query(
    "order_violations",
    "SELECT epoch_us(t) AS updated_at, o_orderkey, count(*) AS rows FROM ("
    "SELECT o_orderdate AS t, o_orderkey FROM orders UNION ALL "
    "SELECT o_orderdate, o_orderkey FROM orders WHERE o_orderkey % 29 = 0) "
    "GROUP BY t, o_orderkey HAVING count(*) > 1 OR t < TIMESTAMP '1996-05-28' "
    "OR (t = TIMESTAMP '1996-05-28' AND o_orderkey <= 7000)",
)
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("updated_at")
    )
    repeated = rows.unionByName(rows.where(F.col("o_orderkey") % 29 == 0))
    found = changes.order_violations(changes.in_order(repeated, SPEC), SPEC, CURSOR)
    return found.withColumn("updated_at", F.unix_micros("updated_at"))


@query(
    "watermark_advance",
    f"WITH {_SOURCE} SELECT epoch_us(updated_at) AS cursor_updated_at, o_orderkey AS cursor_key "
    f"FROM source WHERE {_AFTER} ORDER BY updated_at DESC, o_orderkey DESC LIMIT 1",
)
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.changed_since(_source(spark, sf_dir), SPEC, CURSOR, moment(BOUND))
    last = changes.watermark_of(rows, SPEC)
    return last.withColumn("cursor_updated_at", F.unix_micros("cursor_updated_at"))


@query(
    "source_profile",
    f"WITH {_SOURCE} SELECT count(*) AS row_count, epoch_us(max(updated_at)) AS max_updated_at, "
    "max(row_version) AS max_version, min(o_orderkey) AS min_key, "
    "coalesce(max(o_orderkey), 0) AS max_key FROM source",
)
def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = changes.source_profile(_source(spark, sf_dir), SPEC)
    return profile.withColumn("max_updated_at", F.unix_micros("max_updated_at"))


_SAMPLE = "SELECT o_orderkey FROM orders ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 100"


@query("sample_keys", _SAMPLE)
def sample_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.sample_keys(orders.table(spark, sf_dir, "orders"), "o_orderkey", 100, "7")


@query(
    "versioned_update",
    f"""WITH {_SOURCE}, said AS (
  SELECT l_orderkey AS k, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS st,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS price
  FROM lineitem GROUP BY ALL),
judged AS (
  SELECT *, k IS NOT NULL AND (st IS DISTINCT FROM o_orderstatus
    OR price IS DISTINCT FROM CAST(o_totalprice AS DECIMAL(12,2))) AS differs
  FROM source LEFT JOIN said ON k = o_orderkey)
SELECT o_orderkey, o_custkey, CASE WHEN differs THEN st ELSE o_orderstatus END AS o_orderstatus,
       CAST(CASE WHEN differs THEN price ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS VARCHAR) AS o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority,
       o_clerk, o_shippriority, o_comment, c_name, c_mktsegment, c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal,
       CASE WHEN differs THEN row_version + 1 ELSE row_version END AS row_version,
       epoch_us(CASE WHEN differs THEN TIMESTAMP '2024-06-01 12:00:00' ELSE updated_at END) AS updated_at
FROM judged""",
)
def versioned_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders brought up to what their lines say."""
    changes = orders.line_totals(orders.table(spark, sf_dir, "lineitem"))
    updated = orders.merge_versions(
        _source(spark, sf_dir), changes, key="o_orderkey", updated_at=moment(LOADED)
    )
    return _flat(updated)


def _capture(spark: SparkSession, sf_dir: str) -> Capture:
    """Two cycles over the orders: up to a bound, then the rest."""

    def open_at(path: str) -> Capture:
        return Capture(spark, path, SPEC, settle_seconds=0, batch_size=BATCH)

    def build(path: str) -> None:
        capture, source = open_at(path), _source(spark, sf_dir)
        capture.run_cycle(source, as_of=BOUND)
        capture.run_cycle(source, as_of=LOADED)

    return open_at(once(spark, sf_dir, "capture", build))


_CYCLES = f"""{_SOURCE},
cycled AS (SELECT *, CASE WHEN updated_at <= TIMESTAMP '1999-01-01' THEN 0 ELSE 1 END AS cycle FROM source),
cranked AS (SELECT *, (row_number() OVER (PARTITION BY cycle ORDER BY updated_at, o_orderkey) - 1) // {BATCH} AS batch_no,
            {_EVENT_ID} AS event_id FROM cycled),
batches AS (
  SELECT cycle, batch_no, count(*) AS row_count, count(*) FILTER (WHERE row_version = 1) AS inserts,
         max(updated_at) AS end_at, arg_max(o_orderkey, struct_pack(u := updated_at, k := o_orderkey)) AS end_key,
         arg_min(event_id, struct_pack(u := updated_at, k := o_orderkey)) AS first_event_id,
         arg_max(event_id, struct_pack(u := updated_at, k := o_orderkey)) AS last_event_id
  FROM cranked GROUP BY cycle, batch_no)
"""
_BATCH_ID = event_uuid("'batch|parquet:orders|' || cycle || '|' || batch_no")


@query(
    "ledger_status",
    f"""WITH {_CYCLES}
SELECT cycle, batch_no, {_BATCH_ID} AS batch_id, 'committed' AS status,
       CASE cycle WHEN 0 THEN 'full' ELSE 'incremental' END AS sync_mode,
       epoch_us(lag(end_at) OVER w) AS cursor_start_at, CAST(lag(end_key) OVER w AS VARCHAR) AS cursor_start_key,
       epoch_us(end_at) AS cursor_end_at, CAST(end_key AS VARCHAR) AS cursor_end_key,
       row_count, inserts, row_count - inserts AS updates, first_event_id, last_event_id
FROM batches WINDOW w AS (ORDER BY cycle, batch_no)""",
)
def ledger_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _capture(spark, sf_dir).ledger.batches()
    return rows.select(
        "cycle", "batch_no", "batch_id", "status", "sync_mode", _us("cursor_start_at"),
        "cursor_start_key", _us("cursor_end_at"), "cursor_end_key", "row_count", "inserts",
        "updates", "first_event_id", "last_event_id",
    )


@query(
    "watermark",
    f"""WITH {_CYCLES}, last AS (SELECT * FROM batches ORDER BY cycle DESC, batch_no DESC LIMIT 1)
SELECT 'parquet:orders' AS source_id, epoch_us(end_at) AS cursor_updated_at,
       CAST(end_key AS VARCHAR) AS cursor_key, {_BATCH_ID} AS last_batch_id, TRUE AS initial_sync_done
FROM last""",
)
def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = watermarks(_capture(spark, sf_dir).ledger.cycles())
    return rows.select(
        "source_id", _us("cursor_updated_at"), "cursor_key", "last_batch_id",
        F.col("initial_sync_completed_at").isNotNull().alias("initial_sync_done"),
    )


@query(
    "recent_batches",
    f"WITH {_CYCLES} SELECT cycle, batch_no, {_BATCH_ID} AS batch_id, row_count FROM batches "
    "ORDER BY cycle DESC, batch_no DESC LIMIT 5",
)
def recent_batches_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of one cycle start together; the later batch counts as newer."""
    batches = _capture(spark, sf_dir).ledger.batches()
    ordered = F.make_dt_interval(secs=F.col("batch_no").cast("decimal(18,6)"))
    epoch = F.timestamp_micros(F.col("cycle") * F.lit(10**15))
    return recent_batches(batches.withColumn("started_at", epoch + ordered)).select(
        "cycle", "batch_no", "batch_id", "row_count"
    )


@query(
    "captured_log",
    f"""WITH {_CYCLES} SELECT CAST(o_orderkey AS VARCHAR) AS key, event_id, {_BATCH_ID} AS batch_id,
       CASE WHEN row_version = 1 THEN 'insert' ELSE 'update' END AS event_type,
       CAST(cycle AS BIGINT) AS cycle, TRUE AS in_order
FROM cranked""",
)
def captured_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published records; within a partition they keep the capture order."""
    capture = _capture(spark, sf_dir)
    log = spark.read.parquet(capture.log_path)
    value = F.parse_json(F.col("value").cast("string"))
    at = F.variant_get(value, "$.occurred_at", "string")
    rows = log.select(
        F.col("key").cast("string").alias("key"),
        F.element_at("headers", "event_id").alias("event_id"),
        F.element_at("headers", "batch_id").alias("batch_id"),
        F.element_at("headers", "event_type").alias("event_type"),
        F.col("cycle").cast("bigint").alias("cycle"),
        "partition",
        "offset",
        at.alias("at"),
    )
    # Each record against its predecessor, found by its offset.
    before = rows.select(
        "partition", (F.col("offset") + 1).alias("offset"), F.col("at").alias("at_before"),
        F.col("key").cast("bigint").alias("key_before"),
    )
    position = F.struct("at", F.col("key").cast("bigint").alias("k"))
    previous = F.struct(F.col("at_before").alias("at"), F.col("key_before").alias("k"))
    in_order = F.when(F.col("at_before").isNull(), F.col("offset") == 0).otherwise(
        position > previous
    )
    return rows.join(before, ["partition", "offset"], "left").select(
        "key", "event_id", "batch_id", "event_type", "cycle", in_order.alias("in_order")
    )
