"""Expected normalised relations in plain SQL over the driver tables, as CTEs.

They restate the rules of ``fixtures`` without any JSON parsing, so that each
query's answer can be computed independently of the engine under test.
"""

NULL_TEXT = "CAST(NULL AS VARCHAR)"
NULL_INT = "CAST(NULL AS INTEGER)"

STATUS = """CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'WARN' WHEN 'view' THEN 'debug'
            WHEN 'signup' THEN 'ok' WHEN 'purchase' THEN 'info' END"""
SEVERITY = """CAST(CASE event_type WHEN 'error' THEN 17 WHEN 'click' THEN 13 WHEN 'view' THEN 5
              WHEN 'signup' THEN 9 WHEN 'purchase' THEN 9 END AS INTEGER)"""
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_HOST = "CASE WHEN user_id % 11 <> 0 THEN '\"host\":\"h' || (user_id % 5) || '\"' END"
_TAGS = """CASE WHEN event_id % 13 <> 0 THEN '"ddtags":["env:' ||
           CASE WHEN user_id % 4 = 0 THEN 'staging' ELSE 'prod' END || '","team:t' || (user_id % 3) || '"]' END"""

LOGS = f"""
logs_src AS (
  SELECT *,
    (event_id * 7919 % 5000) * 1000000 AS duration_ns,
    CASE WHEN event_type = 'signup' THEN 'audit' ELSE 'main' END AS idx,
    CASE WHEN user_id % 11 <> 0 THEN 'h' || (user_id % 5) END AS host,
    CASE WHEN event_id % 13 <> 0 THEN CASE WHEN user_id % 4 = 0 THEN 'staging' ELSE 'prod' END END AS env,
    CASE WHEN event_id % 13 <> 0 THEN 't' || (user_id % 3) END AS team
  FROM events),
logs AS (
  SELECT
    epoch_us(ts) * 1000 + event_id % 1000 AS time_unix_nano,
    epoch_us(ts) * 1000 + event_id % 1000 AS observed_time_unix_nano,
    CASE WHEN event_id % 3 = 0 THEN format('{{:032x}}', event_id * 2) END AS trace_id,
    CASE WHEN event_id % 3 = 0 THEN format('{{:016x}}', event_id * 16) END AS span_id,
    CASE WHEN event_id % 97 <> 0 THEN 'svc-' || (user_id % 7) END AS service_name,
    {NULL_TEXT} AS service_namespace, {NULL_TEXT} AS service_instance_id,
    {SEVERITY} AS severity_number, {STATUS} AS severity_text, {NULL_TEXT} AS event_name,
    event_type || ' event ' || event_id AS body,
    '{{' || nullif(concat_ws(',', {_HOST}, {_TAGS}), '') || '}}' AS resource_attributes,
    {NULL_TEXT} AS scope_name, {NULL_TEXT} AS scope_version, {NULL_TEXT} AS scope_attributes,
    '{{"k":' || {K} || ',"duration_ns":' || duration_ns || ',"http":{{"status_code":' ||
      CASE WHEN event_type = 'error' THEN 500 ELSE 200 END || ',"method":"GET"}}' ||
      CASE WHEN event_id % 3 = 0 THEN ',"trace_id":"' || format('{{:032x}}', event_id * 2) ||
        '","span_id":"' || format('{{:016x}}', event_id * 16) || '"' ELSE '' END || '}}' AS log_attributes,
    {NULL_INT} AS dropped_attributes_count, {NULL_INT} AS flags,
    event_id, user_id, event_type, idx, host, env, team, duration_ns, {K} AS k,
    event_id // 1000 AS scan, event_id % 1000 // 100 AS page
  FROM logs_src)"""

LOG_COLUMNS = """time_unix_nano, observed_time_unix_nano, trace_id, span_id, service_name, service_namespace,
  service_instance_id, severity_number, severity_text, event_name, body, resource_attributes, scope_name,
  scope_version, scope_attributes, log_attributes, dropped_attributes_count, flags"""

SPANS = f"""
lines AS (
  SELECT l_orderkey, l_linenumber AS ln, min(l_suppkey) AS suppkey, max(l_returnflag) AS flag,
         min(l_shipdate) AS shipped, sum(l_quantity) AS quantity
  FROM lineitem GROUP BY 1, 2),
spans_src AS (
  SELECT
    epoch_us(o_orderdate) * 1000 AS start_time_unix_nano,
    (o_orderkey % 60) * 1000000000 AS duration_time_unix_nano,
    format('{{:032x}}', o_orderkey) AS trace_id, format('{{:016x}}', o_orderkey * 8) AS span_id,
    {NULL_TEXT} AS parent_span_id, 'orders' AS service_name, 'order.place' AS name,
    CAST(2 AS INTEGER) AS kind,
    CAST(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END AS INTEGER) AS status_code,
    {NULL_TEXT} AS status_status_message,
    '{{"host":"h' || (o_custkey % 5) || '","env":"prod","ddtags":["env:prod","span.kind:SERVER"]}}'
      AS resource_attributes,
    '{{"operation_name":"order.place","priority":"' || o_orderpriority ||
      '","type":"order","resource_name":"place order"}}' AS span_attributes,
    o_orderkey AS order_key, o_orderkey * 8 AS span_no, CAST(NULL AS BIGINT) AS ln
  FROM orders
  UNION ALL
  SELECT
    (epoch_us(shipped) + ln * 1000000) * 1000, CAST(quantity AS BIGINT) * 1000000,
    format('{{:032x}}', l_orderkey), format('{{:016x}}', l_orderkey * 8 + ln), format('{{:016x}}', l_orderkey * 8),
    'supplier-' || (suppkey % 10), 'ship line ' || ln,
    CAST(CASE WHEN ln % 2 = 0 THEN 3 ELSE 5 END AS INTEGER),
    CAST(CASE WHEN flag = 'R' OR (flag = 'N' AND ln % 2 = 0) THEN 2 ELSE 0 END AS INTEGER),
    CASE WHEN flag = 'N' AND ln % 2 = 0 THEN 'line ' || ln || ' late' END,
    CASE WHEN ln % 2 <> 0 THEN '{{"ddtags":["team:x","span.kind:consumer"]}}' END,
    '{{"duration":' || (CAST(quantity AS BIGINT) * 1000000) ||
      CASE WHEN ln % 2 = 0 THEN ',"span":{{"kind":"client"}}' ELSE '' END ||
      CASE WHEN flag = 'N' AND ln % 2 = 0 THEN ',"error":{{"message":"line ' || ln || ' late"}}'
           WHEN flag = 'N' THEN ',"error":{{}}' ELSE '' END ||
      ',"resource_name":"ship line ' || ln || '","type":"db","single_span":false}}',
    l_orderkey, l_orderkey * 8 + ln, ln
  FROM lines),
spans AS (
  SELECT start_time_unix_nano, duration_time_unix_nano, trace_id, span_id, parent_span_id,
    {NULL_TEXT} AS trace_state, service_name, {NULL_TEXT} AS service_namespace,
    {NULL_TEXT} AS service_instance_id, name, kind, status_code, status_status_message, resource_attributes,
    {NULL_TEXT} AS scope_name, {NULL_TEXT} AS scope_version, {NULL_TEXT} AS scope_attributes, span_attributes,
    {NULL_TEXT} AS events_json, {NULL_TEXT} AS links_json, {NULL_INT} AS dropped_attributes_count,
    {NULL_INT} AS dropped_events_count, {NULL_INT} AS dropped_links_count, {NULL_INT} AS flags,
    order_key, span_no, ln
  FROM spans_src)"""

SPAN_COLUMNS = """start_time_unix_nano, duration_time_unix_nano, trace_id, span_id, parent_span_id, trace_state,
  service_name, service_namespace, service_instance_id, name, kind, status_code, status_status_message,
  resource_attributes, scope_name, scope_version, scope_attributes, span_attributes, events_json, links_json,
  dropped_attributes_count, dropped_events_count, dropped_links_count, flags"""

METRICS = f"""
hourly AS (
  SELECT event_type, date_trunc('hour', ts) AS hr, sum(CAST(round(value * 100) AS BIGINT)) AS cents
  FROM events GROUP BY 1, 2),
metrics AS (
  SELECT epoch_us(hr) * 1000 AS time_unix_nano, CAST(NULL AS BIGINT) AS start_time_unix_nano,
    'events.value' AS name, {NULL_TEXT} AS description, 'cent' AS unit, CAST(NULL AS BIGINT) AS int_value,
    CAST(cents AS DOUBLE) AS double_value, event_type AS service_name, 'shop' AS service_namespace,
    {NULL_TEXT} AS service_instance_id,
    '{{"acme.site":"acme.example","host":"h1"}}' AS resource_attributes,
    {NULL_TEXT} AS scope_name, {NULL_TEXT} AS scope_version, {NULL_TEXT} AS scope_attributes,
    '{{"tags":["type:' || event_type || '","service:' || event_type ||
      '","host:h1","service_namespace:shop"],"scope":"type:' || event_type ||
      '","metric":"events.value","unit":"cent"}}' AS metric_attributes,
    {NULL_INT} AS flags, {NULL_TEXT} AS exemplars_json
  FROM hourly WHERE hour(hr) % 7 <> 0)"""

ALERTS = """
alert_groups AS (
  SELECT event_type AS scan_id, user_id // 100 AS page_no, user_id, length(event_type) AS monitor_id,
    event_type AS monitor_name, 'user:' || user_id AS group_name,
    CASE WHEN user_id % 9 = 0 THEN NULL WHEN user_id % 10 = 0 THEN '[]'
         ELSE '["user:' || user_id || '","type:' || event_type || '"]' END AS group_tags,
    CASE count(*) % 4 WHEN 0 THEN 'Alert' WHEN 1 THEN 'Warn' WHEN 2 THEN 'No Data' ELSE 'OK' END AS status,
    date_trunc('second', max(ts)) AS last_triggered_at,
    CASE WHEN user_id % 2 <> 0 THEN date_trunc('second', max(ts)) - INTERVAL 60 SECOND END AS last_nodata_at
  FROM events GROUP BY event_type, user_id)"""

ALERT_COLUMNS = (
    "monitor_id, monitor_name, group_name, group_tags, status, last_triggered_at, last_nodata_at"
)

EDGE_TAIL = f"""{NULL_TEXT} AS source_type, {NULL_TEXT} AS target_type, {NULL_TEXT} AS edge_type"""

DEPENDENCIES = f"""
edges_api AS (
  SELECT DISTINCT 'acme' AS provider, n_name AS source_service, s_name AS target_service, {EDGE_TAIL},
    'prod' AS environment, TIMESTAMP '2024-01-01 00:00:00' AS window_start,
    TIMESTAMP '2024-01-31 00:00:00' AS window_end,
    CAST(NULL AS BIGINT) AS request_count, CAST(NULL AS BIGINT) AS error_count,
    CAST(NULL AS BIGINT) AS fault_count, CAST(NULL AS BIGINT) AS throttle_count,
    CAST(NULL AS DOUBLE) AS total_response_time_seconds,
    {NULL_TEXT} AS source_attributes, {NULL_TEXT} AS target_attributes, {NULL_TEXT} AS edge_attributes
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

SPAN_EDGES = f"""
edges_spans AS (
  SELECT 'acme' AS provider, p.service_name AS source_service, c.service_name AS target_service, {EDGE_TAIL},
    'prod' AS environment,
    make_timestamp((min(c.start_time_unix_nano) // 1000000000) * 1000000) AS window_start,
    make_timestamp((max(c.start_time_unix_nano) // 1000000000 + 1) * 1000000) AS window_end,
    count(*) AS request_count, CAST(sum(CASE WHEN c.status_code = 2 THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
    CAST(NULL AS BIGINT) AS fault_count, CAST(NULL AS BIGINT) AS throttle_count,
    round(sum(c.duration_time_unix_nano) / 1e9, 6) AS total_response_time_seconds,
    {NULL_TEXT} AS source_attributes, {NULL_TEXT} AS target_attributes, {NULL_TEXT} AS edge_attributes
  FROM spans c JOIN spans p ON c.trace_id = p.trace_id AND c.parent_span_id = p.span_id
  WHERE p.service_name <> c.service_name GROUP BY 2, 3)"""

# Intake requests: every event of a sound request, and the verdict on every request.
INTAKE = f"""
requests AS (
  SELECT DISTINCT event_id // 50 AS request, event_id // 50 % 20 AS kind FROM events),
intake_src AS (
  SELECT *, event_id // 50 AS request, event_id // 50 % 20 AS kind,
    1704067200000000000 + (event_id // 50) * 1000000 AS received
  FROM events),
intake AS (
  SELECT
    CASE event_id % 5 WHEN 0 THEN epoch_us(ts) // 1000 * 1000000 WHEN 1 THEN epoch_us(ts) // 1000 * 1000000
      WHEN 2 THEN epoch_us(ts) * 1000 WHEN 3 THEN epoch_us(ts) // 1000 * 1000000 + 500000
      ELSE received END AS time_unix_nano,
    received AS observed_time_unix_nano, CAST(event_id AS VARCHAR) AS trace_id, {NULL_TEXT} AS span_id,
    'svc-' || (user_id % 7) AS service_name, {NULL_TEXT} AS service_namespace,
    {NULL_TEXT} AS service_instance_id, {SEVERITY} AS severity_number, {STATUS} AS severity_text,
    {NULL_TEXT} AS event_name,
    CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '{{"text":"x","n":1}}'
         WHEN event_id % 19 = 0 THEN 'null' WHEN event_id % 23 = 0 THEN NULL
         ELSE event_type || ' ' || event_id END AS body,
    '{{' || nullif(concat_ws(',',
      CASE user_id % 3 WHEN 0 THEN '"host":"n' || (user_id % 5) || '"'
                       WHEN 1 THEN '"host":"h' || (user_id % 5) || '"' END,
      CASE WHEN event_id % 4 = 0 THEN '"ddsource":"app"' END,
      CASE WHEN event_id % 13 = 0 THEN '"ddtags":[]'
           WHEN event_id % 2 = 0 THEN '"ddtags":["env:prod","team:t' || (user_id % 3) || '"]' END), '')
      || '}}' AS resource_attributes,
    {NULL_TEXT} AS scope_name, {NULL_TEXT} AS scope_version, {NULL_TEXT} AS scope_attributes,
    '{{"dd.trace_id":"' || event_id || '","trace_id":"other","k":' || {K} ||
      ',"nested":{{"a":1,"b":[1,2]}}}}' AS log_attributes,
    {NULL_INT} AS dropped_attributes_count, {NULL_INT} AS flags, request, kind, event_id
  FROM intake_src WHERE kind NOT IN (4, 5, 6, 8, 12, 13))"""

REJECTS = """
  SELECT lpad(CAST(request AS VARCHAR), 8, '0') AS request_id,
    CAST(CASE kind WHEN 8 THEN 403 WHEN 13 THEN 413 ELSE 400 END AS INTEGER) AS code,
    CASE kind WHEN 4 THEN 'the body cannot be read as JSON' WHEN 5 THEN 'the body is neither an object nor an array'
      WHEN 6 THEN 'the body has an entry that is no object' WHEN 8 THEN 'the key does not match'
      WHEN 12 THEN 'the body has an array of more than 1000 logs' ELSE 'the body is over the size limit' END AS reason
  FROM requests WHERE kind IN (4, 5, 6, 8, 12, 13)"""
