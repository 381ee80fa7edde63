"""SQL for DuckDB that each query is compared with.

The statements share their beginnings: `log` to `good` turn the activity log into events, `message`
to `letter` do so for the damaged messages, `metric` holds the three kinds of aggregate.
"""

from __future__ import annotations

EVENT = ["event_id", "event_type", "timestamp", "user_id", "session_id", "product_id", "product_category",
         "price_cents", "quantity", "search_query", "page_url", "referrer", "user_agent", "ip_address",
         "geo_country", "geo_city"]
REQUIRED = ["event_id", "event_type", "geo_country", "ip_address", "page_url", "session_id", "timestamp",
            "user_agent", "user_id"]
SOURCE = ["source_topic", "source_partition", "source_offset"]
STORED = """event_id, event_type, timestamp AS event_timestamp_ms, user_id, session_id, product_id,
    product_category, price_cents, quantity, revenue_cents, search_query, page_url, referrer, user_agent,
    ip_address, geo_country, geo_city, event_hour, is_mobile"""
MINUTE, FIVE, HOUR, DAY = 60_000, 300_000, 3_600_000, 86_400_000
LATE = 30_000
GAP, LONG_GAP = 1_800_000, 21_600_000
SPACE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

EVENTS = """
log AS (
  SELECT event_id AS eid, user_id AS uid, event_type AS et, round(value * 100)::BIGINT AS cents,
         epoch_us(ts) // 1000 AS ms, json_extract_string(props, '$.k')::BIGINT AS k
  FROM events),
named AS (
  SELECT *, CASE WHEN et = 'view' THEN 'page_view' WHEN et = 'signup' THEN 'search' WHEN et <> 'click' THEN et
                 WHEN k % 10 < 6 THEN 'add_to_cart' WHEN k % 10 < 8 THEN 'remove_from_cart' ELSE 'wishlist' END AS kind
  FROM log),
event AS (
  SELECT eid::VARCHAR AS event_id, kind AS event_type, ms AS "timestamp",
         'user_' || lpad(uid::VARCHAR, 6, '0') AS user_id,
         'sess_' || uid || '_' || (ms // 86400000) AS session_id,
         CASE WHEN kind <> 'search' THEN 'prod_' || lpad(k::VARCHAR, 5, '0') END AS product_id,
         CASE WHEN kind NOT IN ('search', 'remove_from_cart') THEN 'cat_' || (k % 10) END AS product_category,
         CASE WHEN kind NOT IN ('search', 'remove_from_cart')
              THEN CASE WHEN eid % 97 = 0 THEN -cents ELSE cents END END AS price_cents,
         CASE WHEN kind IN ('add_to_cart', 'wishlist', 'purchase')
              THEN CASE WHEN eid % 89 = 0 THEN 0 ELSE (1 + k % 5)::INTEGER END END AS quantity,
         CASE WHEN kind = 'search' THEN '  Query ' || k || ' ' END AS search_query,
         'https://shop.example.com/' || kind || '/' || k AS page_url,
         CASE WHEN uid % 2 = 0 THEN 'https://www.example.org/' END AS referrer,
         CASE uid % 7 WHEN 0 THEN 'Googlebot/2.1' WHEN 1 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_3 like Mac OS X)'
              WHEN 2 THEN 'Mozilla/5.0 (Linux; Android 14) Chrome/121.0.0.0 Mobile' WHEN 3 THEN ''
              ELSE 'Mozilla/5.0 (X11; Linux x86_64) Firefox/122.0' END AS user_agent,
         '10.0.0.' || (uid % 250) AS ip_address,
         CASE uid % 5 WHEN 0 THEN ' us' WHEN 1 THEN 'GB' WHEN 2 THEN '  ' WHEN 4 THEN 'de' END AS geo_country,
         CASE uid % 3 WHEN 0 THEN 'Berlin' WHEN 1 THEN 'Paris' END AS geo_city,
         'clickstream.events' AS source_topic, (uid % 6)::INTEGER AS source_partition, eid AS source_offset
  FROM named)"""

BOT = "regexp_matches(lower(coalesce(user_agent, '')), 'bot|crawler|spider|scrapy|curl|wget|httpx')"
RULES = """CASE
  WHEN event_type IS NULL OR event_type NOT IN
       ('page_view', 'add_to_cart', 'remove_from_cart', 'purchase', 'search', 'wishlist')
    THEN 'Invalid event_type: ' || coalesce(event_type, 'None')
  WHEN "timestamp" IS NULL OR "timestamp" <= 0 OR "timestamp" > 253402300799999
    THEN 'Invalid timestamp: ' || coalesce("timestamp"::VARCHAR, 'None')
  WHEN event_type = 'purchase' AND price_cents < 0 THEN 'Negative price_cents: ' || price_cents
  WHEN event_type = 'purchase' AND quantity <= 0 THEN 'Invalid quantity: ' || quantity END"""
COUNTRY = f"coalesce(nullif(trim(upper(geo_country), {SPACE}), ''), 'UNKNOWN')"
SEARCH = f"lower(trim(search_query, {SPACE}))"
REVENUE = "CASE WHEN event_type = 'purchase' THEN coalesce(price_cents, 0) * coalesce(quantity, 0) ELSE 0 END::BIGINT"
HOUR_OF_DAY = '("timestamp" // 3600000 % 24)::INTEGER'
MOBILE = "regexp_matches(lower(coalesce(user_agent, '')), 'mobile|iphone|android|ipad')"


def processed(source: str) -> str:
    """Accepted rows of `source`, normalized and enriched."""
    return f"""SELECT * REPLACE ({COUNTRY} AS geo_country, {SEARCH} AS search_query),
         {REVENUE} AS revenue_cents, {HOUR_OF_DAY} AS event_hour, {MOBILE} AS is_mobile
  FROM {source} WHERE error_reason IS NULL"""


CHECKED = EVENTS + f""",
checked AS (
  SELECT *, coalesce({RULES}, CASE WHEN {BOT} THEN 'Filtered as bot traffic' END) AS error_reason FROM event)"""
GOOD = CHECKED + f""",
good AS ({processed("checked")})"""


def _json(without: tuple[str, ...] = ()) -> str:
    return "to_json({" + ", ".join(f"'{c}': \"{c}\"" for c in EVENT if c not in without) + "})::VARCHAR"


# The raw value is text unless its number divides by 109; then a byte follows that is not UTF-8.
MESSAGES = EVENTS + f""",
body AS (
  SELECT *, CASE WHEN source_offset % 101 = 0 THEN {_json(("ip_address", "user_id"))}
                 WHEN source_offset % 107 = 0 THEN {_json(("geo_country",))} ELSE {_json()} END AS whole
  FROM event),
message AS (
  SELECT source_topic, source_partition, source_offset, source_offset % 109 = 0 AS broken,
         CASE WHEN source_offset % 103 = 0 THEN left(whole, length(whole) // 2) ELSE whole END AS txt
  FROM body),
parsed AS (
  SELECT *, NOT broken AND json_valid(txt) AS ok, CASE WHEN NOT broken AND json_valid(txt) THEN txt END AS doc
  FROM message),
decoded AS (
  SELECT {", ".join(f"json_extract_string(doc, '$.{c}')::BIGINT AS {c}" if c in ("timestamp", "price_cents") else
                    f"json_extract_string(doc, '$.{c}')::INTEGER AS {c}" if c == "quantity" else
                    f"json_extract_string(doc, '$.{c}') AS {c}" for c in EVENT)},
         source_topic, source_partition, source_offset, txt, broken,
         CASE WHEN broken THEN 'Deserialization error: value is not UTF-8 text'
              WHEN NOT ok THEN 'Deserialization error: value does not match the event schema' END AS decode_error,
         CASE WHEN ok THEN list_filter({REQUIRED}, lambda f: NOT list_contains(json_keys(doc), f)) END AS absent
  FROM parsed)"""


def missing(absent: str) -> str:
    return (f"CASE WHEN len({absent}) > 0 THEN 'Missing required fields: [''' || "
            f"array_to_string({absent}, ''', ''') || ''']' END")


JUDGED = MESSAGES + f""",
judged AS (
  SELECT *, coalesce(decode_error, {missing("absent")}, {RULES},
                     CASE WHEN {BOT} THEN 'Filtered as bot traffic' END) AS error_reason
  FROM decoded)"""
LETTERS = JUDGED + """,
letter AS (
  SELECT CASE WHEN broken THEN base64(encode(txt) || '\\xFF'::BLOB) ELSE txt END AS original_payload, error_reason,
         source_topic, source_partition, source_offset,
         source_topic || ':' || source_partition || ':' || source_offset AS key
  FROM judged WHERE error_reason IS NOT NULL)"""

MEASURES = """count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
    count(*) FILTER (event_type = 'page_view') AS page_views,
    count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
    count(*) FILTER (event_type = 'purchase') AS purchases, sum(revenue_cents)::BIGINT AS total_revenue_cents"""


def tumbling(name: str, kind: str, size: int) -> str:
    """CTEs ending in `name`: tumbling windows with joined top lists."""
    def ranked(column: str, k: int, out: str) -> str:
        return f"""
{name}_{out} AS (
  SELECT ws, string_agg(key, ',' ORDER BY pos) AS {out} FROM (
    SELECT *, row_number() OVER (PARTITION BY ws ORDER BY n DESC, first_ms, key) AS pos FROM (
      SELECT "timestamp" // {size} * {size} AS ws, {column} AS key, count(*) AS n, min("timestamp") AS first_ms
      FROM good WHERE {column} IS NOT NULL AND {column} <> '' GROUP BY ALL))
  WHERE pos <= {k} GROUP BY ws)"""

    return f"""{ranked("product_id", 10, "top_products")},{ranked("product_category", 5, "top_categories")},
{name}_counts AS (SELECT "timestamp" // {size} * {size} AS ws, {MEASURES} FROM good GROUP BY ws),
{name} AS (
  SELECT md5('{kind}|' || ws) AS window_id, '{kind}' AS window_type, ws AS window_start, ws + {size} AS window_end,
         event_count, unique_users, page_views, add_to_carts, purchases, total_revenue_cents,
         coalesce(top_products, '') AS top_products, coalesce(top_categories, '') AS top_categories
  FROM {name}_counts LEFT JOIN {name}_top_products USING (ws) LEFT JOIN {name}_top_categories USING (ws))"""


def sessions(name: str, gap: int) -> str:
    return f"""
{name}_marked AS (
  SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER w <= {gap} THEN 0 ELSE 1 END AS opens FROM good
  WINDOW w AS (PARTITION BY user_id, session_id ORDER BY "timestamp", source_offset)),
{name}_numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id, session_id ORDER BY "timestamp", source_offset) AS run
  FROM {name}_marked),
{name} AS (
  SELECT user_id, session_id, md5('session_summary|' || min("timestamp") || '|' || user_id || '|' || session_id)
           AS window_id, 'session_summary' AS window_type, min("timestamp") AS window_start,
         max("timestamp") AS window_end, {MEASURES}, '' AS top_products, '' AS top_categories
  FROM {name}_numbered GROUP BY user_id, session_id, run)"""


METRIC = (GOOD + "," + tumbling("per_minute", "events_per_minute", MINUTE) + ","
          + tumbling("per_five", "revenue_per_5min", FIVE) + "," + sessions("per_session", GAP) + """,
metric AS (
  FROM per_minute UNION ALL FROM per_five UNION ALL SELECT * EXCLUDE (user_id, session_id) FROM per_session)""")

# The same of the messages that pass.
KEPT_METRIC = JUDGED + f""",
good AS ({processed("judged")}),""" + METRIC[len(GOOD) + 1:]

NEWEST = '(SELECT max("timestamp") FROM good)'
UTC = "strftime(make_timestamp({} * 1000000), '%Y-%m-%d %H:%M:%S')"


def clock(ms: str) -> str:
    return UTC.format(f"({ms} // 1000)")


def half_up(part: str, whole: str, digits: int) -> str:
    """100 * part / whole, rounded half up in whole numbers."""
    scale = 10 ** digits
    return (f"CASE WHEN {whole} > 0 THEN (200 * {scale} * ({part})::HUGEINT + {whole}) // (2 * {whole}) "
            f"/ {float(scale)} END::DOUBLE")


def over_time(span: int, size: int) -> str:
    return f"""SELECT {clock(f'"timestamp" // {size} * {size}')} AS event_minute, count(*) AS event_count,
       count(DISTINCT user_id) AS unique_users
FROM good WHERE "timestamp" > {NEWEST} - {span} GROUP BY 1"""


def ranks(column: str, k: int) -> str:
    return f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, first_ms, key)::INTEGER AS rank FROM (
    SELECT "timestamp" // {DAY} * {DAY} AS window_start, {column} AS key, count(*) AS n, min("timestamp") AS first_ms
    FROM good WHERE {column} <> '' GROUP BY ALL)) WHERE rank <= {k}"""


LATE_EVENTS = GOOD + f""",
arrival AS (
  SELECT * REPLACE (CASE WHEN source_offset % 211 = 0 THEN (source_offset + 1000) * 2 + 1 ELSE source_offset * 2 END
                    AS source_offset) FROM good),
seen AS (
  SELECT *, "timestamp" // {FIVE} * {FIVE} AS window_start, "timestamp" // {FIVE} * {FIVE} + {FIVE} AS window_end,
         max("timestamp") OVER (PARTITION BY source_partition ORDER BY source_offset
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest_ms
  FROM arrival),
late AS (SELECT * FROM seen WHERE window_end + {LATE} <= newest_ms)"""


def histogram(parts: int) -> str:
    """Sizes of the micro-batches of a log that arrives in parts, by position."""
    bounds = [10, 50, 100, 250, 500, 1000]
    lines = [f"SELECT '{b}' AS le, count(*) FILTER (size <= {b}) AS batches, count(*) AS batch_count, "
             f"sum(size)::BIGINT AS row_sum FROM batch" for b in bounds]
    lines.append("SELECT '+Inf', count(*), count(*), sum(size)::BIGINT FROM batch")
    return f"""
WITH whole AS (SELECT max(event_id) + 1 AS n FROM events),
part AS (SELECT p * n // {parts} AS low, (p + 1) * n // {parts} AS high FROM whole, range({parts}) AS r(p)),
batch AS (SELECT count(*) AS size FROM events JOIN part ON event_id >= low AND event_id < high GROUP BY low)
""" + "\nUNION ALL ".join(lines)


def constraint_rows(table: str, source: str, keys: str, columns: list[str]) -> str:
    null_rows = "".join(
        f"\nUNION ALL SELECT '{table}', 'not_null', '{c}', count(*) - count({c}) FROM {source}" for c in columns)
    return (f"SELECT '{table}' AS table_name, 'unique' AS check_name, '{keys}' AS column_name, "
            f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {source})) AS violations FROM {source}"
            + null_rows)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


_CLOSED = f"window_end + {LATE} <= {NEWEST}"
_CONSTRAINTS = METRIC + "," + LETTERS[len(EVENTS) + 1:] + f""",
twice AS (SELECT {STORED} FROM good UNION ALL SELECT {STORED} FROM good)"""

ORACLE: dict[str, str] = {
    "decode_json_events": _with(MESSAGES, f"""
SELECT {", ".join(EVENT)}, {", ".join(SOURCE)}, decode_error, array_to_string(absent, ',') AS absent_fields
FROM decoded"""),
    "validate_required_json": _with(MESSAGES, f"""
SELECT {", ".join(SOURCE)}, {missing("absent")} AS error_reason FROM decoded WHERE len(absent) > 0"""),
    "validate_events": _with(EVENTS, f"SELECT event_id, event_type, {RULES} AS error_reason FROM event"),
    "filter_bots": _with(EVENTS, f"SELECT event_id, user_id, user_agent FROM event WHERE NOT {BOT}"),
    "route_good": _with(CHECKED, f"SELECT {', '.join(EVENT)} FROM checked WHERE error_reason IS NULL"),
    "route_dlq": _with(CHECKED, f"""
SELECT event_id, {", ".join(SOURCE)}, error_reason FROM checked WHERE error_reason IS NOT NULL"""),
    "normalize_events": _with(EVENTS, f"""
SELECT event_id, {COUNTRY} AS geo_country, {SEARCH} AS search_query FROM event"""),
    "enrich_events": _with(EVENTS, f"""
SELECT event_id, {REVENUE} AS revenue_cents, {HOUR_OF_DAY} AS event_hour, {MOBILE} AS is_mobile FROM event"""),
    "process_events": _with(GOOD, f"SELECT {STORED} FROM good"),
    "dlq_envelope": _with(LETTERS, "FROM letter"),
    "dlq_message": _with(LETTERS, """
SELECT key, to_json({'original_payload': original_payload, 'error_reason': error_reason, 'source_topic': source_topic,
       'source_partition': source_partition, 'source_offset': source_offset})::VARCHAR AS value FROM letter"""),
    "dlq_by_class": _with(LETTERS, """
SELECT split_part(error_reason, ':', 1) AS reason_class, count(*) AS letters FROM letter GROUP BY 1"""),
    "dlq_replay": _with(JUDGED + f""",
repaired AS (
  SELECT * REPLACE (abs(price_cents) AS price_cents, CASE WHEN quantity < 1 THEN 1 ELSE coalesce(quantity, 1) END AS quantity,
                    list_filter(absent, lambda f: f <> 'geo_country') AS absent)
  FROM judged WHERE error_reason IS NOT NULL),
again AS (
  SELECT * REPLACE (coalesce(decode_error, {missing("absent")}, {RULES},
                             CASE WHEN {BOT} THEN 'Filtered as bot traffic' END) AS error_reason) FROM repaired),
passed AS ({processed("again")})""", f"SELECT {STORED} FROM passed"),
    "idempotent_insert": _with(GOOD, f"""
SELECT {STORED}, source_offset FROM good WHERE "timestamp" >= 1705363200000"""),
    "table_constraint_check": _with(_CONSTRAINTS, "\nUNION ALL ".join([
        constraint_rows("clickstream_events", "twice", "event_id",
                        ["event_id", "event_type", "event_timestamp_ms", "user_id", "session_id", "page_url"]),
        constraint_rows("aggregated_metrics", "metric", "window_id",
                        ["window_id", "window_type", "window_start", "window_end", "event_count", "unique_users"]),
        constraint_rows("dead_letter_events", "letter", "source_topic,source_partition,source_offset", ["error_reason"]),
    ])),
    "keyed_publish": _with(EVENTS, f"SELECT user_id AS key, {_json()} AS value FROM event"),
    "metrics_publish": _with(METRIC, """
SELECT window_type AS key, * REPLACE (
       to_json(CASE WHEN top_products = '' THEN [] ELSE string_split(top_products, ',') END)::VARCHAR AS top_products,
       to_json(CASE WHEN top_categories = '' THEN [] ELSE string_split(top_categories, ',') END)::VARCHAR AS top_categories)
FROM metric"""),
    "q01_events_over_time": _with(GOOD, over_time(HOUR, MINUTE)),
    "q01_events_per_second": _with(GOOD, over_time(DAY, 1_000)),
    "q02_revenue_by_category": _with(GOOD, f"""
SELECT product_category, count(*) AS purchase_count, sum(revenue_cents)::BIGINT / 100.0 AS total_revenue_dollars,
       sum(revenue_cents)::BIGINT::DOUBLE / count(revenue_cents) / 100.0 AS avg_order_value_dollars
FROM good WHERE event_type = 'purchase' AND "timestamp" > {NEWEST} - {DAY} GROUP BY 1"""),
    "q03_funnel": _with(GOOD + """,
tally AS (SELECT count(*) FILTER (event_type = 'page_view') AS v, count(*) FILTER (event_type = 'add_to_cart') AS c,
                 count(*) FILTER (event_type = 'purchase') AS p FROM good)""", f"""
SELECT 'page_view' AS stage, v AS "count", 100.0::DOUBLE AS pct FROM tally
UNION ALL SELECT 'add_to_cart', c, {half_up("c", "v", 1)} FROM tally
UNION ALL SELECT 'purchase', p, {half_up("p", "v", 1)} FROM tally"""),
    "q04_top_products": _with(GOOD, """
SELECT product_id, product_category, count(*) AS interactions, count(*) FILTER (event_type = 'purchase') AS purchases,
       sum(revenue_cents)::BIGINT / 100.0 AS revenue_dollars
FROM good WHERE product_id IS NOT NULL GROUP BY ALL
ORDER BY interactions DESC, product_id, product_category NULLS FIRST LIMIT 10"""),
    "q05_session_analysis": _with(GOOD, """
SELECT session_id, user_id, count(*) AS events_in_session,
       (max("timestamp") - min("timestamp")) / 1000.0 AS session_duration_seconds,
       count(DISTINCT page_url) AS unique_pages, bool_or(event_type = 'purchase') AS converted
FROM good GROUP BY ALL HAVING count(*) > 1
ORDER BY session_duration_seconds DESC, session_id, user_id LIMIT 20"""),
    "q06_geo": _with(GOOD, """
SELECT geo_country, geo_city, count(*) AS events, count(DISTINCT user_id) AS unique_users,
       sum(revenue_cents)::BIGINT / 100.0 AS revenue_dollars
FROM good GROUP BY ALL ORDER BY events DESC, geo_country, geo_city NULLS FIRST LIMIT 15"""),
    "q07_mobile_conversion": _with(GOOD + """,
device AS (SELECT is_mobile, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS p FROM good GROUP BY 1)""", f"""
SELECT if(is_mobile, 'Mobile', 'Desktop') AS platform, n AS total_events, p AS purchases,
       {half_up("p", "n", 2)} AS purchase_rate_pct FROM device"""),
    "q08_hourly": _with(GOOD, """
SELECT event_hour, count(*) AS events, count(DISTINCT user_id) AS unique_users,
       sum(revenue_cents)::BIGINT / 100.0 AS revenue_dollars FROM good GROUP BY 1"""),
    "q09_dlq_inspection": _with(CHECKED, f"""
SELECT error_reason, count(*) AS error_count, {clock('min("timestamp")')} AS first_seen,
       {clock('max("timestamp")')} AS last_seen, split_part(error_reason, ':', 1) AS reason_class
FROM checked WHERE error_reason IS NOT NULL GROUP BY error_reason"""),
    "q10_window_history": _with(METRIC, f"""
SELECT window_type, {clock("window_start")} AS window_start_ts, {clock("window_end")} AS window_end_ts, event_count,
       unique_users, purchases, total_revenue_cents / 100.0 AS revenue_dollars,
       array_to_string(string_split(top_categories, ',')[1:3], ',') AS top_3_categories
FROM metric ORDER BY window_start DESC, window_type, window_id LIMIT 20"""),
    "tumbling_1m": _with(GOOD + "," + tumbling("w", "events_per_minute", MINUTE), "FROM w"),
    "tumbling_5m": _with(GOOD + "," + tumbling("w", "revenue_per_5min", FIVE), "FROM w"),
    "window_top_products": _with(GOOD, ranks("product_id", 10)),
    "window_top_categories": _with(GOOD, ranks("product_category", 5)),
    "all_window_metrics": _with(METRIC, "FROM metric"),
    "sessions": _with(GOOD + "," + sessions("s", GAP), "FROM s"),
    "sessions_6h": _with(GOOD + "," + sessions("s", LONG_GAP), "FROM s"),
    "open_windows": _with(GOOD, "\nUNION ALL ".join(
        f"""SELECT '{kind}' AS window_type, count(DISTINCT "timestamp" // {size}) AS open_windows FROM good
WHERE "timestamp" // {size} * {size} + {size + LATE} > {NEWEST}"""
        for kind, size in [("events_per_minute", MINUTE), ("revenue_per_5min", FIVE)])),
    "open_sessions": _with(GOOD + "," + sessions("s", LONG_GAP), f"""
SELECT count(*) AS open_sessions FROM s WHERE window_end + {LONG_GAP + LATE} > {NEWEST}"""),
    "late_event_report": _with(LATE_EVENTS, """
SELECT event_id, source_partition, source_offset, "timestamp", window_start, window_end, newest_ms,
       newest_ms - "timestamp" AS late_by_ms FROM late"""),
    "restated_windows": _with(LATE_EVENTS + "," + tumbling("w", "revenue_per_5min", FIVE), """
SELECT w.* FROM w WHERE window_start IN (SELECT window_start FROM late)"""),
    "metrics_totals": _with(METRIC + """,
kind AS (SELECT window_type, sum(event_count)::BIGINT AS e, sum(total_revenue_cents)::BIGINT AS r,
                sum(purchases)::BIGINT AS p, sum(unique_users)::BIGINT AS u FROM metric GROUP BY 1)""", """
SELECT window_type, e AS events, r / 100.0 AS revenue_dollars, p AS purchases, u AS summed_users,
       (SELECT sum(e)::BIGINT FROM kind) AS events_all_kinds,
       (SELECT sum(r)::BIGINT / 100.0 FROM kind) AS revenue_dollars_all_kinds,
       (SELECT sum(p)::BIGINT FROM kind) AS purchases_all_kinds,
       (SELECT sum(u)::BIGINT FROM kind) AS summed_users_all_kinds FROM kind"""),
    "metrics_unique_users": _with(GOOD, "SELECT count(DISTINCT user_id) AS unique_users FROM good"),
    "metrics_history": _with(METRIC, "FROM metric ORDER BY window_end DESC, window_type, window_id LIMIT 120"),
    "metrics_latest": _with(METRIC, """
SELECT * FROM metric
QUALIFY row_number() OVER (PARTITION BY window_type ORDER BY window_end DESC, window_id DESC) = 1"""),
    "recent_window_log": _with(METRIC, """
SELECT window_end AS at_ms, window_type, event_count, unique_users, total_revenue_cents / 100.0 AS revenue_dollars
FROM metric WHERE event_count > 0 ORDER BY window_end DESC, window_type, window_id LIMIT 50"""),
    "metrics_running_totals": _with(METRIC, """
SELECT DISTINCT window_type, window_start, count(*) OVER w AS total_windows, (sum(event_count) OVER w)::BIGINT AS total_events,
       (sum(purchases) OVER w)::BIGINT AS total_purchases, (sum(unique_users) OVER w)::BIGINT AS total_summed_users,
       (sum(total_revenue_cents) OVER w)::BIGINT / 100.0 AS total_revenue_dollars
FROM metric WINDOW w AS (PARTITION BY window_type ORDER BY window_start RANGE UNBOUNDED PRECEDING)"""),
    "throughput_between_windows": _with(METRIC + """,
ends AS (SELECT window_type, window_end, sum(event_count)::BIGINT AS events FROM metric GROUP BY ALL),
pace AS (SELECT *, (sum(events) OVER (PARTITION BY window_type ORDER BY window_end))::BIGINT AS total_events, (window_end - lag(window_end) OVER (PARTITION BY window_type ORDER BY window_end)) / 1000.0
                   AS elapsed_seconds FROM ends)""", """
SELECT *, coalesce(events / elapsed_seconds, 0.0)::DOUBLE AS events_per_second FROM pace"""),
    "event_type_distribution": _with(METRIC + """,
bar AS (
  SELECT window_id, window_type, window_start,
         unnest(['page_view', 'search', 'add_to_cart', 'purchase', 'wishlist']) AS event_type,
         unnest([page_views, greatest(event_count - page_views - add_to_carts - purchases, 0), add_to_carts, purchases,
                 0]) AS n
  FROM metric)""", """
SELECT window_id, window_type, window_start, event_type, n AS "count",
       100.0 * n / greatest(max(n) OVER (PARTITION BY window_id), 1)::DOUBLE AS pct_of_max FROM bar"""),
    "category_rank_bars": _with(METRIC + """,
listed AS (SELECT window_id, window_type, window_start, string_split(top_categories, ',') AS c FROM metric
           WHERE top_categories <> ''),
bar AS (SELECT *, unnest(c) AS category, unnest(range(1, len(c) + 1))::INTEGER AS rank FROM listed)""", """
SELECT window_id, window_type, window_start, rank, category, 100.0 * (len(c) - rank + 1) / len(c)::DOUBLE AS bar_pct
FROM bar"""),
    "stage_counters": _with(METRIC + "," + JUDGED[len(EVENTS) + 1:], """
SELECT 'events_consumed' AS counter, event_type AS label, count(*) AS value FROM judged WHERE error_reason IS NULL GROUP BY 2
UNION ALL
SELECT 'events_failed', CASE WHEN decode_error IS NOT NULL THEN 'deserialize'
       WHEN error_reason = 'Filtered as bot traffic' THEN 'bot_filter' ELSE 'validate' END, count(*)
FROM judged WHERE error_reason IS NOT NULL GROUP BY 2
UNION ALL SELECT 'events_dlq', 'all', count(*) FROM judged WHERE error_reason IS NOT NULL
UNION ALL SELECT 'aggregations_emitted', window_type, count(*) FROM metric GROUP BY 2"""),
    "batch_size_histogram": histogram(3),
    "batch_size_histogram_small_batches": histogram(8),
    "stream_tumbling_1m": _with(GOOD + "," + tumbling("w", "events_per_minute", MINUTE), f"FROM w WHERE {_CLOSED}"),
    "stream_tumbling_5m": _with(GOOD + "," + tumbling("w", "revenue_per_5min", FIVE), f"FROM w WHERE {_CLOSED}"),
    "stream_sessions": _with(GOOD + "," + sessions("s", LONG_GAP), f"""
SELECT * EXCLUDE (user_id, session_id) FROM s WHERE window_end + {LONG_GAP + LATE} <= {NEWEST}"""),
    "stream_rows": _with(JUDGED + f""",
kept AS ({processed("judged")})""", """
SELECT 'events' AS table_name, event_type AS label, count(*) AS n, sum(revenue_cents)::BIGINT AS revenue_cents
FROM kept GROUP BY 2
UNION ALL SELECT 'dead_letters', error_reason, count(*), 0::BIGINT FROM judged WHERE error_reason IS NOT NULL GROUP BY 2"""),
    "load_then_stream": _with(JUDGED + f""",
kept AS ({processed("judged")})""", """
SELECT 'events' AS table_name, event_id AS row_key, event_type AS label FROM kept
UNION ALL SELECT 'dead_letters', source_topic || ':' || source_partition || ':' || source_offset, error_reason
FROM judged WHERE error_reason IS NOT NULL"""),
    "loaded_metrics": _with(KEPT_METRIC, "FROM metric"),
    "unplaced_dead_letters": _with(LETTERS, """
SELECT original_payload, error_reason, NULL::VARCHAR AS source_topic, NULL::INTEGER AS source_partition, NULL::BIGINT AS source_offset
FROM letter, range(2)"""),
    "stream_then_restate": _with(KEPT_METRIC, f"""
SELECT * FROM metric WHERE window_end + {LATE} + CASE WHEN window_type = 'session_summary' THEN {GAP} ELSE 0 END <= {NEWEST}"""),
    "stream_updates": _with(KEPT_METRIC, """
SELECT window_start, event_count, page_views, add_to_carts, purchases, total_revenue_cents, unique_users
FROM metric WHERE window_type = 'revenue_per_5min'"""),
    "users_by_day": _with(GOOD, f"""
SELECT "timestamp" // {DAY} * {DAY} AS window_start, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       true AS within_bound FROM good GROUP BY 1"""),
    "top_products_by_day": _with(GOOD, f"""
SELECT "timestamp" // {DAY} * {DAY} AS window_start, product_id, count(*) AS n, 0::BIGINT AS error_bound,
       row_number() OVER (PARTITION BY "timestamp" // {DAY} * {DAY} ORDER BY count(*) DESC, product_id)::INTEGER AS rank
FROM good WHERE product_id IS NOT NULL GROUP BY "timestamp" // {DAY} * {DAY}, product_id QUALIFY rank <= 10"""),
    "stream_dedupe": _with(GOOD, f"SELECT {STORED} FROM good"),
}
