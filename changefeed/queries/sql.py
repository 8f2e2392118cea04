"""SQL building blocks: the derived feed and its expected verdicts.

The SQL states by key arithmetic what the feed contains and by window functions
what becomes of each record. It shares no code with the Spark side.
"""

from __future__ import annotations

from changefeed.schemas import EVENT_ID_NAMESPACE, QUARANTINE_NAMESPACE


def uuid5(namespace: str, name: str) -> str:
    sha = f"sha1(unhex('{namespace.replace('-', '')}') || encode({name}))"
    return (
        f"(substr({sha},1,8) || '-' || substr({sha},9,4) || '-5' || substr({sha},14,3) || '-' || "
        f"translate(substr({sha},17,1),'0123456789abcdef','89ab89ab89ab89ab') || "
        f"substr({sha},18,3) || '-' || substr({sha},21,12))"
    )


def event_uuid(name: str) -> str:
    return uuid5(EVENT_ID_NAMESPACE, name)


def quarantine_uuid(name: str) -> str:
    return uuid5(QUARANTINE_NAMESPACE, name)


_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)"

# Every record of the feed with the values its payload carries.
RECORDS = f"""
slots AS (SELECT unnest(range(8)) AS slot),
order_slots AS (
  SELECT o.*, o_orderkey AS k, 1 + o_orderkey % 3 AS nver, slot,
         CASE slot WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 6 THEN 2 + o_orderkey % 3 ELSE 1 END AS version
  FROM orders o CROSS JOIN slots
  WHERE slot = 0
     OR (slot = 1 AND o_orderkey % 3 >= 1) OR (slot = 2 AND o_orderkey % 3 >= 2)
     OR (slot = 3 AND o_orderkey % 7 = 0) OR (slot = 4 AND o_orderkey % 83 = 0)
     OR (slot = 5 AND o_orderkey % 61 = 0) OR (slot = 6 AND o_orderkey % 103 = 0)
     OR (slot = 7 AND o_orderkey % 11 = 0)),
order_values AS (
  SELECT 'order' AS entity_type, 'orders' AS object, CAST(k AS VARCHAR) AS entity_key,
         CAST(version AS BIGINT) AS version, slot, k,
         CAST(k % 6 AS INTEGER) AS part,
         CAST((k // 6) * 8 + (slot * 3 + k) % 8 AS BIGINT) AS off,
         o_orderdate + to_hours(CAST(version AS INTEGER)) AS occurred,
         o_orderdate + to_hours(CAST(version + CASE WHEN slot = 7 THEN 1 ELSE 0 END AS INTEGER))
           + INTERVAL 5 SECOND AS captured,
         {event_uuid("'batch|' || CAST(k // 1000 AS VARCHAR)")} AS batch_id,
         (k // 61) % 6 AS kind,
         CASE WHEN k % 73 = 0 AND version = 3 THEN k + 1 ELSE k END AS p_key,
         o_custkey AS p_cust,
         CASE WHEN k % 89 = 0 AND slot = 0 THEN 'X' ELSE o_orderstatus END AS p_status,
         CASE WHEN k % 97 = 0 AND version = nver THEN '-42.00'
              WHEN k % 101 = 0 AND version = 1 THEN NULL ELSE {_PRICE} END AS p_price,
         CASE WHEN k % 67 = 0 AND version = 2 THEN CAST(o_orderdate AS DATE) + 3650
              ELSE CAST(o_orderdate AS DATE) END AS p_date,
         CASE WHEN slot = 4 THEN 'tampered after publication' WHEN slot = 6 THEN 'bad\\u0000comment'
              WHEN k % 41 = 0 THEN repeat('long comment ', 8) || 'v' || version
              ELSE 'v' || version END AS p_comment
  FROM order_slots),
order_records AS (
  SELECT entity_type, object, entity_key, version, part, off, occurred, captured, batch_id,
         CASE WHEN slot = 5 THEN kind END AS bad_kind,
         '{{"o_comment":"' || p_comment || '","o_custkey":' || p_cust || ',"o_orderdate":"' || p_date
           || '","o_orderkey":' || p_key || ',"o_orderstatus":"' || p_status || '","o_totalprice":'
           || coalesce('"' || p_price || '"', 'null') || '}}' AS payload,
         list_filter([
           CASE WHEN p_key IS NULL THEN 'order_key_present' END,
           CASE WHEN CAST(p_key AS VARCHAR) <> entity_key THEN 'order_key_matches_envelope' END,
           CASE WHEN p_cust IS NULL THEN 'customer_key_present' END,
           CASE WHEN p_price IS NULL THEN 'total_price_present' END,
           CASE WHEN CAST(p_price AS DECIMAL(18,2)) < 0 THEN 'total_price_non_negative' END,
           CASE WHEN p_status NOT IN ('O','F','P') THEN 'order_status_known' END
         ], lambda x: x IS NOT NULL) AS rejects,
         list_filter([
           CASE WHEN p_date > CAST(captured AS DATE) THEN 'order_date_not_after_capture' END,
           CASE WHEN length(p_comment) > 79 THEN 'comment_within_source_limit' END
         ], lambda x: x IS NOT NULL) AS warns,
         slot = 6 AS unstorable
  FROM order_values),
customer_records AS (
  SELECT 'customer' AS entity_type, 'customer' AS object, CAST(c_custkey AS VARCHAR) AS entity_key,
         CAST(1 AS BIGINT) AS version, CAST(6 + c_custkey % 2 AS INTEGER) AS part,
         CAST(c_custkey // 2 AS BIGINT) AS off,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(c_custkey % 24 AS INTEGER)) AS occurred,
         TIMESTAMP '2024-01-01 00:00:05' + to_hours(CAST(c_custkey % 24 AS INTEGER)) AS captured,
         {event_uuid("'batch|customer'")} AS batch_id,
         CAST(NULL AS BIGINT) AS bad_kind,
         '{{"c_acctbal":"' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || '","c_custkey":'
           || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name
           || '","c_nationkey":' || c_nationkey || '}}' AS payload,
         CAST([] AS VARCHAR[]) AS rejects, CAST([] AS VARCHAR[]) AS warns, FALSE AS unstorable
  FROM customer),
plain AS (
  SELECT * FROM order_records UNION ALL BY NAME SELECT * FROM customer_records),
records AS (
  SELECT *, CASE WHEN version = 1 THEN 'insert' ELSE 'update' END AS event_type,
         {event_uuid("'parquet|' || object || '|' || entity_type || '|' || entity_key || '|' || version")} AS event_id,
         CAST(part AS HUGEINT) * 1000000000000 + off AS ord,
         len(rejects) = 0 AND NOT unstorable AS ok
  FROM plain),
prints AS (
  SELECT *, sha256('{{"entity_key":"' || entity_key || '","entity_type":"' || entity_type
           || '","entity_version":' || version || ',"event_type":"' || event_type
           || '","occurred_at":"' || strftime(occurred, '%Y-%m-%dT%H:%M:%SZ') || '","payload":' || payload
           || ',"source":{{"object":"' || object || '","system":"parquet"}}}}') AS fp
  FROM records)
"""

# Verdict and outcome of every record, starting from empty tables.
VERDICTS = f"""{RECORDS},
firsts AS (
  SELECT *, CASE WHEN bad_kind IS NULL
                 THEN min(CASE WHEN ok AND bad_kind IS NULL THEN ord END) OVER (PARTITION BY event_id) END AS fpo
  FROM prints),
logged AS (
  SELECT *, max(CASE WHEN bad_kind IS NULL AND ord = fpo THEN fp END) OVER (PARTITION BY event_id) AS logged_fp
  FROM firsts),
verdicts AS (
  SELECT *, CASE WHEN bad_kind IS NOT NULL THEN 'schema_violation'
                 WHEN ord > fpo AND fp = logged_fp THEN 'duplicate'
                 WHEN ord > fpo THEN 'event_id_conflict'
                 WHEN len(rejects) > 0 THEN 'quality_rule_failed'
                 WHEN unstorable THEN 'sink_rejected' ELSE 'accepted' END AS verdict
  FROM logged),
spans AS (
  SELECT part, min(off) AS first_off,
         1 + coalesce(sum(max(off) - min(off) + 1) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_seq
  FROM verdicts GROUP BY part),
numbered AS (
  SELECT v.*, CAST(first_seq + off - first_off AS BIGINT) AS seq
  FROM verdicts v JOIN spans s ON v.part = s.part),
accepted AS (SELECT * FROM numbered WHERE verdict = 'accepted'),
outcomes AS (
  SELECT *, CASE WHEN version > coalesce(max(version) OVER (
              PARTITION BY entity_type, entity_key ORDER BY ord
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            THEN 'applied' ELSE 'stale' END AS outcome
  FROM accepted),
state AS (
  SELECT entity_type, entity_key, max(version) AS version,
         arg_max(payload, version) AS payload, arg_max(event_id, version) AS event_id,
         arg_max(event_type, version) AS event_type, arg_max(occurred, version) AS occurred
  FROM accepted GROUP BY entity_type, entity_key),
rejected AS (
  SELECT *, CASE WHEN verdict = 'schema_violation'
                 THEN {quarantine_uuid("'record:changes:' || part || ':' || off")}
                 ELSE {quarantine_uuid("'event:' || event_id || ':' || fp || ':' || verdict")} END AS quarantine_id
  FROM numbered WHERE verdict NOT IN ('accepted', 'duplicate')),
quarantined AS (
  SELECT quarantine_id, min(seq) AS quarantine_seq, arg_min(verdict, seq) AS reason,
         arg_min(CASE WHEN verdict = 'schema_violation' AND bad_kind < 2 THEN NULL ELSE event_id END, seq) AS event_id,
         arg_min(CASE WHEN verdict = 'schema_violation' AND bad_kind < 2 THEN NULL ELSE batch_id END, seq) AS batch_id,
         arg_min(CASE WHEN verdict = 'schema_violation' THEN NULL ELSE entity_type END, seq) AS entity_type,
         arg_min(entity_key, seq) AS entity_key, arg_min(part, seq) AS part, arg_min(off, seq) AS off,
         arg_min(rejects, seq) AS rejects, arg_min(warns, seq) AS warns
  FROM rejected GROUP BY quarantine_id)
"""


def with_records(select: str) -> str:
    return f"WITH {RECORDS} {select}"


def with_verdicts(select: str) -> str:
    return f"WITH {VERDICTS} {select}"
