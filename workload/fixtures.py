"""Raw telemetry rendered from the driver tables, whole tables at a time.

Each function gives a DataFrame of raw bodies as a landing table would hold them.
All rules are plain column arithmetic so that the checking SQL can state the
expected normalised rows without going through JSON.
"""

from pyspark.sql import functions as F

PAGE_ROWS = 100
SCAN_ROWS = 1000
REQUEST_ROWS = 50
API_KEY = "intake-key"
MAX_BODY_BYTES = 393_216

# Status text per event type, in the spellings the severity table must cope with.
STATUS = {"error": "error", "click": "WARN", "view": "debug", "signup": "ok", "purchase": "info"}


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _status_case(column="event_type"):
    branches = " ".join(f"when '{kind}' then '{status}'" for kind, status in STATUS.items())
    return f"case {column} {branches} end"


# One JSON object per event, written out as text so that types and key order are exactly these.
LOG_EVENT = f"""
concat(
  '{{"id":"e', event_id, '","attributes":{{',
  '"timestamp":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), lpad(event_id % 1000, 3, '0'), 'Z",',
  case when event_id % 97 = 0 then '"service":7,'
       else concat('"service":"svc-', user_id % 7, '",') end,
  '"status":"', {_status_case()}, '",',
  '"message":"', event_type, ' event ', event_id, '",',
  case when user_id % 11 = 0 then '' else concat('"host":"h', user_id % 5, '",') end,
  '"tags":', case when event_id % 13 = 0 then '[]'
       else concat('["env:', if(user_id % 4 = 0, 'staging', 'prod'), '","team:t', user_id % 3, '"]') end, ',',
  '"attributes":{{"k":', get_json_object(props, '$.k'),
  ',"duration_ns":', (event_id * 7919 % 5000) * 1000000,
  ',"http":{{"status_code":', case when event_type = 'error' then 500 else 200 end, ',"method":"GET"}}',
  case when event_id % 3 = 0 then concat(
       ',"trace_id":"', lpad(lower(hex(event_id * 2)), 32, '0'),
       '","span_id":"', lpad(lower(hex(event_id * 16)), 16, '0'), '"') else '' end,
  '}}}}}}')
"""


def log_events(spark, sf, *keys):
    """One raw log event per row of ``events`` with its scan, page and index.

    With ``keys`` the rows are dealt out by them before the text is rendered, so that pages shuffle narrow columns only.
    """
    rows = table(spark, sf, "events").selectExpr(
        "*",
        f"cast(event_id div {SCAN_ROWS} as string) as scan_id",
        f"event_id % {SCAN_ROWS} div {PAGE_ROWS} as page_no",
        "if(event_type = 'signup', 'audit', 'main') as `index`",
    )
    rows = rows.repartition(*keys) if keys else rows
    return rows.selectExpr("event_id", "scan_id", "page_no", "`index`", f"{LOG_EVENT} as event")


def _bodies(events, *keys):
    ordered = F.sort_array(F.collect_list(F.struct("event_id", "event")))
    return events.groupBy(*keys).agg(F.array_join(ordered["event"], ",").alias("items"))


def log_pages(spark, sf):
    """Well-formed log search pages of 100 events, ten to a scan."""
    pages = _bodies(log_events(spark, sf, "scan_id", "page_no"), "scan_id", "page_no")
    return pages.selectExpr(
        "scan_id",
        "page_no",
        "if(page_no = 0, '', cast(page_no as string)) as cursor",
        """concat('{"data":[', items, ']', if(page_no = 9, '',
           concat(',"meta":{"page":{"after":"', page_no + 1, '"}}')), '}') as body""",
    )


def indexed_log_pages(spark, sf):
    """Log pages whose events all belong to one index, as catalog tables land them."""
    pages = _bodies(log_events(spark, sf, "index", "scan_id", "page_no"), "index", "scan_id", "page_no")
    return pages.selectExpr(
        "`index`", "scan_id", "page_no", "'' as cursor", """concat('{"data":[', items, ']}') as body"""
    )


def catalog_log_pages(spark, sf):
    """Log pages of one index each, every scan of an index with a whole cursor chain."""
    pages = _bodies(log_events(spark, sf, "index", "scan_id", "page_no"), "index", "scan_id", "page_no")
    return pages.selectExpr(
        "`index`",
        "concat(`index`, '-', scan_id) as scan_id",
        "page_no",
        "if(page_no = 0, '', cast(page_no as string)) as cursor",
        """concat('{"data":[', items, '],"meta":{"page":{"after":"', if(page_no = 9, '', cast(page_no + 1 as string)), '"}}}') as body""",
    )


def land(spark, sf, path):
    """A landing folder with every kind of table, rendered from the driver tables."""
    from telemere.plans.landing import land_pages

    land_pages(catalog_log_pages(spark, sf), f"{path}/logs", ["index"])
    # Each span page is a scan of its own here: its cursor chain is one page long.
    whole = span_pages(spark, sf).withColumn("scan_id", F.concat_ws("-", "scan_id", "page_no"))
    land_pages(whole.withColumn("page_no", F.lit(0)), f"{path}/spans")
    metric_responses(spark, sf).selectExpr(
        "'sum:events.value{*} by {type}' as query",
        "unix_seconds(cast(scan_id as timestamp)) as start_s",
        "unix_seconds(cast(scan_id as timestamp)) + 86399 as end_s",
        "body",
    ).write.parquet(f"{path}/metrics")
    alert_pages(spark, sf).write.parquet(f"{path}/alerts")
    dependency_responses(spark, sf, 200).selectExpr(
        "'prod' as environment",
        "cast(null as string) as primary_tag",
        "1704067200L as start_s",
        "1706659200L as end_s",
        "body",
    ).write.parquet(f"{path}/service_dependencies")
    index_responses(spark, sf).select("body").write.parquet(f"{path}/indexes")
    return path


def broken_chain_pages(spark, sf):
    """Log pages whose chains end early in each possible way, by scan number modulo 5."""
    pages = log_pages(spark, sf)
    scan = "cast(scan_id as long) % 5"
    head = "substring_index(body, ',\"meta\"', 1)"
    return pages.selectExpr(
        "scan_id",
        "page_no",
        "cursor",
        f"""case
          when {scan} = 1 and page_no = 6
            then concat({head}, ',"meta":{{"page":{{"after":"6"}}}}}}')
          when {scan} = 2 and page_no = 4
            then '{{"data":[],"meta":{{"page":{{"after":"5"}}}}}}'
          when {scan} = 3 and page_no = 7 then concat({head}, '}}')
          when {scan} = 4 and page_no = 8
            then concat({head}, ',"meta":{{"page":{{"after":""}}}}}}')
          else body end as body""",
    )


ROOT_SPAN = """
concat(
  '{"attributes":{"start_timestamp":"', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '",',
  '"end_timestamp":"', date_format(o_orderdate + make_interval(0, 0, 0, 0, 0, 0, o_orderkey % 60),
                                   "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), '",',
  '"trace_id":"', lpad(lower(hex(o_orderkey)), 32, '0'), '",',
  '"span_id":"', lpad(lower(hex(o_orderkey * 8)), 16, '0'), '",',
  '"service":"orders","resource_name":"place order","type":"web",',
  '"host":"h', o_custkey % 5, '","env":"prod","tags":["env:prod","span.kind:SERVER"],',
  case o_orderstatus when 'F' then '"status":"OK",' when 'P' then '"error":true,' else '"error":0,' end,
  '"custom":{"operation_name":"order.place","priority":"', o_orderpriority, '","type":"order"}}}')
"""

CHILD_SPAN = """
concat(
  '{"attributes":{"start_timestamp":"', date_format(shipped + make_interval(0, 0, 0, 0, 0, 0, l_linenumber),
                                                    "yyyy-MM-dd'T'HH:mm:ssXXX"), '",',
  '"trace_id":"', lpad(lower(hex(l_orderkey)), 32, '0'), '",',
  '"span_id":"', lpad(lower(hex(l_orderkey * 8 + l_linenumber)), 16, '0'), '",',
  '"parent_id":"', lpad(lower(hex(l_orderkey * 8)), 16, '0'), '",',
  '"service":"supplier-', suppkey % 10, '","resource_name":"ship line ', l_linenumber, '",',
  '"type":"db","single_span":false,"ingestion_reason":null,',
  case when l_linenumber % 2 = 0 then '"tags":[],' else '"tags":["team:x","span.kind:consumer"],' end,
  case flag when 'R' then '"status":"Error",' when 'A' then '"status":"ok",' else '' end,
  '"custom":{"duration":', cast(quantity as bigint) * 1000000,
  case when l_linenumber % 2 = 0 then ',"span":{"kind":"client"}' else '' end,
  case when flag = 'N' and l_linenumber % 2 = 0 then concat(',"error":{"message":"line ', l_linenumber, ' late"}')
       when flag = 'N' then ',"error":{}' else '' end,
  '}}}')
"""


def _order_lines(lineitem, *keys):
    """One row per distinct order line with what its span is rendered from."""
    return lineitem.groupBy(*keys, "l_orderkey", "l_linenumber").agg(
        F.min("l_suppkey").alias("suppkey"),
        F.max("l_returnflag").alias("flag"),
        F.min("l_shipdate").alias("shipped"),
        F.sum("l_quantity").alias("quantity"),
    )


# The span of a row of ``span_rows``.
SPAN = f"if(is_root, {ROOT_SPAN}, {CHILD_SPAN})"


def span_rows(spark, sf):
    """What the spans of ``span_events`` are rendered from: ``event_id``, ``ms`` (the start) and narrow columns."""
    start = "unix_seconds(cast({} as timestamp)) * 1000 as ms"
    roots = table(spark, sf, "orders").selectExpr(
        "true as is_root", "o_orderkey * 8 as event_id", start.format("o_orderdate"),
        "o_orderkey", "o_orderdate", "o_custkey", "o_orderstatus", "o_orderpriority",
    )
    children = _order_lines(table(spark, sf, "lineitem")).selectExpr(
        "false as is_root", "l_orderkey * 8 + l_linenumber as event_id",
        start.format("shipped + make_interval(0, 0, 0, 0, 0, 0, l_linenumber)"), "*",
    )
    return roots.unionByName(children, allowMissingColumns=True)


SPAN_PAGE = {"scan_id": "cast({} div 1000 as string)", "page_no": "{} % 1000 div 25"}


def span_events(spark, sf, by_page=False):
    """A root span per order and a child span per distinct order line.

    ``by_page`` adds the page of each and deals rows out by it before the text is rendered.
    """

    def keyed(name, order_key):
        rows = table(spark, sf, name)
        if not by_page:
            return rows
        keys = {key: F.expr(rule.format(order_key)) for key, rule in SPAN_PAGE.items()}
        return rows.withColumns(keys).repartition(*keys)

    page = list(SPAN_PAGE) if by_page else []
    roots = keyed("orders", "o_orderkey").selectExpr(
        *page, "o_orderkey as order_key", "o_orderkey * 8 as event_id", f"{ROOT_SPAN} as event"
    )
    lines = _order_lines(keyed("lineitem", "l_orderkey"), *page)
    children = lines.selectExpr(
        *page, "l_orderkey as order_key", "l_orderkey * 8 + l_linenumber as event_id", f"{CHILD_SPAN} as event"
    )
    return roots.unionByName(children)


def span_pages(spark, sf):
    """Span search pages, each with the spans of 25 orders."""
    return _bodies(span_events(spark, sf, by_page=True), *SPAN_PAGE).selectExpr(
        "scan_id", "page_no", "'' as cursor", """concat('{"data":[', items, ']}') as body"""
    )


def metric_responses(spark, sf):
    """One metric response per day: a series per event type with an hourly point of summed cents."""
    hourly = (
        table(spark, sf, "events")
        .groupBy("event_type", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    )
    points = hourly.selectExpr(
        "cast(hour as date) as day",
        "event_type",
        "unix_seconds(cast(hour as timestamp)) as sec",
        "concat('[', unix_seconds(cast(hour as timestamp)) * 1000, ',', "
        "if(hour(hour) % 7 = 0, 'null', cast(cents as string)), ']') as point",
    )
    ordered = F.array_sort(F.collect_list(F.struct("sec", "point")))
    series = points.groupBy("day", "event_type").agg(
        F.array_join(F.transform(ordered, lambda p: p["point"]), ",").alias("points")
    )
    rendered = series.selectExpr(
        "day",
        "event_type",
        """concat('{"metric":"events.value","scope":"type:', event_type, '","tag_set":["type:', event_type,
           '","service:', event_type, '","host:h1","service_namespace:shop"],"pointlist":[', points, ']}') as item""",
    )
    items = F.array_sort(F.collect_list(F.struct("event_type", "item")))
    return rendered.groupBy("day").agg(
        F.array_join(F.transform(items, lambda i: i["item"]), ",").alias("items")
    ).selectExpr(
        "cast(day as string) as scan_id",
        """concat('{"series":[', items, '],"unit":[{"short_name":"","name":"cent"}]}') as body""",
    )


def alert_pages(spark, sf):
    """Monitor-group pages: one scan per event type, one group per user, by hundreds of user ids."""
    groups = (
        table(spark, sf, "events")
        .groupBy("event_type", "user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))
    )
    rendered = groups.selectExpr(
        "event_type as scan_id",
        "user_id div 100 as page_no",
        "user_id as event_id",
        """concat('{"monitor_id":', length(event_type), ',"monitor_name":"', event_type,
          '","group":"user:', user_id, '","group_tags":', case when user_id % 9 = 0 then 'null'
              when user_id % 10 = 0 then '[]' else concat('["user:', user_id, '","type:', event_type, '"]') end,
          ',"status":"', case n % 4 when 0 then 'Alert' when 1 then 'Warn' when 2 then 'No Data' else 'OK' end,
          '","last_triggered_ts":', unix_seconds(cast(last as timestamp)),
          ',"last_nodata_ts":', if(user_id % 2 = 0, 0, unix_seconds(cast(last as timestamp)) - 60), '}') as event""",
    )
    total = """case scan_id when 'click' then ',"metadata":{"total_count":120}'
                            when 'error' then ',"metadata":{"total_count":50}'
                            when 'view' then ',"metadata":null' else '' end"""
    return _bodies(rendered, "scan_id", "page_no").selectExpr(
        "scan_id", "page_no", "'' as cursor", f"""concat('{{"groups":[', items, ']', {total}, '}}') as body"""
    )


def alert_history(spark, sf):
    """The same monitor groups once per day, for latest-state queries."""
    groups = (
        table(spark, sf, "events")
        .groupBy("event_type", "user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rendered = groups.selectExpr(
        "cast(day as string) as scan_id",
        "user_id div 100 as page_no",
        "user_id as event_id",
        """concat('{"monitor_id":', length(event_type), ',"monitor_name":"', event_type,
          '","group":"user:', user_id, '","status":"',
          case (n + dayofmonth(day)) % 3 when 0 then 'Alert' when 1 then 'OK' else 'Warn' end, '"}') as event""",
    )
    return _bodies(rendered, "scan_id", "page_no").selectExpr(
        "scan_id", "page_no", "'' as cursor", """concat('{"groups":[', items, ']}') as body"""
    )


def dependency_responses(spark, sf, per_body=None):
    """Dependency objects: each nation calls its suppliers, the first one of a body twice.

    One for each region or, with ``per_body``, also for each so many supplier keys, so that bodies do not grow.
    """
    suppliers = table(spark, sf, "supplier")
    nations = table(spark, sf, "nation")
    part = F.call_function("div", "s_suppkey", F.lit(per_body)) if per_body else F.lit(0).cast("long")
    calls = (
        suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"])
        .withColumn("part", part)
        .groupBy("n_regionkey", "part", "n_name")
        .agg(F.array_sort(F.collect_list(F.concat(F.lit('"'), "s_name", F.lit('"')))).alias("calls"))
    )
    entries = calls.select(
        "n_regionkey",
        "part",
        F.concat(
            F.lit('"'),
            "n_name",
            F.lit('":{"calls":['),
            F.array_join(F.concat("calls", F.slice("calls", 1, 1)), ","),
            F.lit('],"note":1}'),
        ).alias("entry"),
    )
    return entries.groupBy(F.col("n_regionkey").cast("string").alias("scan_id"), "part").agg(
        F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list("entry")), ","), F.lit("}")).alias("body")
    ).drop("part")


def aggregate_responses(spark, sf):
    """One aggregation response per day: event counts by service and type, plus a total bucket."""
    counts = (
        table(spark, sf, "events")
        .selectExpr("cast(ts as date) as day", "user_id % 7 as svc", "event_type")
        .groupBy("day", "svc", "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    buckets = counts.selectExpr(
        "day",
        "n",
        """concat('{"by":{"service":"svc-', svc, '","type":"', event_type, '"},"computes":{"c0":',
           if(n % 5 = 0, 'null', cast(n as string)), ',"c1":0}}') as bucket""",
    )
    return buckets.groupBy("day").agg(
        F.array_join(F.array_sort(F.collect_list("bucket")), ",").alias("items"), F.sum("n").alias("total")
    ).selectExpr(
        "cast(day as string) as scan_id",
        """concat('{"data":{"buckets":[', items, ',{"computes":{"c0":', total, '}}]}}') as body""",
    )


def index_responses(spark, sf):
    """One index list per thousand events, names in event order with many repeats."""
    named = log_events(spark, sf).join(
        table(spark, sf, "events").select("event_id", "event_type", "user_id"), "event_id"
    )
    named = named.selectExpr(
        "scan_id", "event_id", """concat('{"name":"', event_type, '-', user_id % 10, '"}') as event"""
    )
    return _bodies(named, "scan_id").selectExpr(
        "scan_id", """concat('{"indexes":[', items, ']}') as body"""
    )


INTAKE_OBJECT = f"""
concat(
  '{{', case when event_id % 29 = 0 then '' when event_id % 17 = 0 then '"message":{{"text":"x","n":1}},'
             when event_id % 19 = 0 then '"message":null,' when event_id % 23 = 0 then '"message":"",'
             else concat('"message":"', event_type, ' ', event_id, '",') end,
  '"service":"svc-', user_id % 7, '","status":"', {_status_case()}, '",',
  '"timestamp":', case event_id % 5
      when 0 then cast(unix_millis(cast(ts as timestamp)) as string)
      when 1 then concat('"', unix_millis(cast(ts as timestamp)), '"')
      when 2 then concat('"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), '"')
      when 3 then concat(unix_millis(cast(ts as timestamp)), '.5')
      else '"soon"' end, ',',
  case when user_id % 3 = 0 then concat('"hostname":"n', user_id % 5, '","host":"ignored",')
       when user_id % 3 = 1 then concat('"host":"h', user_id % 5, '",') else '' end,
  case when event_id % 13 = 0 then '"ddtags":" , ",'
       when event_id % 2 = 0 then concat('"ddtags":"env:prod, team:t', user_id % 3, ',,",') else '' end,
  case when event_id % 4 = 0 then '"ddsource":"app",' else '' end,
  '"dd.trace_id":"', event_id, '","trace_id":"other","k":', get_json_object(props, '$.k'),
  ',"nested":{{"a":1,"b":[1,2]}}}}')
"""


def intake_requests(spark, sf):
    """Intake requests of 50 events in every framing, with every kind of bad request.

    By request number modulo 20: 4 truncated JSON, 5 a scalar, 6 a string element,
    8 a wrong key, 12 an array of 1050 logs, 13 a body over the limit.
    """
    events = table(spark, sf, "events").selectExpr(
        f"event_id div {REQUEST_ROWS} as request", "event_id", "ts", f"{INTAKE_OBJECT} as event"
    )
    ordered = F.array_sort(F.collect_list(F.struct("event_id", "event")))
    requests = events.groupBy("request").agg(F.transform(ordered, lambda e: e["event"]).alias("logs"))
    kind = "request % 20"
    return requests.selectExpr(
        "lpad(request, 8, '0') as request_id",
        "1704067200000000000 + request * 1000000 as received_unix_nano",
        f"""case when {kind} in (1, 11) then 'application/x-ndjson' when {kind} in (2, 9) then 'Text/Plain'
                 when {kind} = 3 then 'application/json; charset=utf-8' else 'application/json' end as content_type""",
        f"if({kind} = 8, 'wrong', '{API_KEY}') as api_key",
        f"""case
          when {kind} in (1, 2) then array_join(logs, '\\n')
          when {kind} = 9 then concat('\\n  \\n', array_join(logs, ' \\r\\n\\n'), '\\n')
          when {kind} = 11 then concat('[', array_join(slice(logs, 1, 25), ','), ']\\n',
                                       array_join(slice(logs, 26, 25), '\\n'))
          when {kind} = 4 then concat('[', array_join(logs, ','))
          when {kind} = 5 then '42'
          when {kind} = 6 then concat('[', array_join(logs, ','), ',"text"]')
          when {kind} = 12 then concat('[', array_join(flatten(array_repeat(logs, 21)), ','), ']')
          when {kind} = 13 then concat('[', array_join(logs, ','), ']', repeat(' ', {MAX_BODY_BYTES}))
          else concat('[', array_join(logs, ','), ']') end as body""",
    )
