"""Adapter: a generic activity log (event_id, ts, user_id, event_type, value, props) as clickstream rows.

The log has no products, sessions, agents or places; they are derived from its columns by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import clock
from clickloom.functions.barrier import once
from clickloom.schemas import EVENT_SCHEMA, SOURCE_COLUMNS

LOG_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
TOPIC = "clickstream.events"
PARTITIONS = 6


def read_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a stream refuses a path that is a single file.
    return spark.readStream.schema(LOG_SCHEMA).parquet(f"{sf_dir}/event[s].parquet")


# One event per log row, from the row's number n, its user u, the number k in its props, its time ms,
# and the event type that the log's own type and k stand for.
EVENT_TYPE = """
    CASE type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'search' WHEN 'click' THEN
        CASE WHEN k % 10 < 6 THEN 'add_to_cart' WHEN k % 10 < 8 THEN 'remove_from_cart' ELSE 'wishlist' END
    ELSE type END"""
EVENT_COLUMNS = [
    "CAST(n AS STRING) AS event_id",
    "event_type",
    "ms AS timestamp",
    "concat('user_', lpad(CAST(u AS STRING), 6, '0')) AS user_id",
    f"concat_ws('_', 'sess', u, ms div {clock.DAY_MS}) AS session_id",
    "CASE WHEN event_type != 'search' THEN concat('prod_', lpad(CAST(k AS STRING), 5, '0')) END AS product_id",
    "CASE WHEN priced THEN concat('cat_', k % 10) END AS product_category",
    "CASE WHEN priced THEN CAST(round(value * 100) AS BIGINT) * IF(n % 97 = 0, -1, 1) END AS price_cents",
    "CASE WHEN event_type IN ('add_to_cart', 'wishlist', 'purchase') THEN IF(n % 89 = 0, 0, CAST(k % 5 + 1 AS INT)) END"
    " AS quantity",
    "CASE WHEN event_type = 'search' THEN concat('  Query ', k, ' ') END AS search_query",
    "concat_ws('/', 'https://shop.example.com', event_type, k) AS page_url",
    "CASE WHEN u % 2 = 0 THEN 'https://www.example.org/' END AS referrer",
    "CASE u % 7 WHEN 0 THEN 'Googlebot/2.1' WHEN 1 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_3 like Mac OS X)'"
    " WHEN 2 THEN 'Mozilla/5.0 (Linux; Android 14) Chrome/121.0.0.0 Mobile' WHEN 3 THEN ''"
    " ELSE 'Mozilla/5.0 (X11; Linux x86_64) Firefox/122.0' END AS user_agent",
    "concat('10.0.0.', u % 250) AS ip_address",
    "CASE u % 5 WHEN 0 THEN ' us' WHEN 1 THEN 'GB' WHEN 2 THEN '  ' WHEN 4 THEN 'de' END AS geo_country",
    "CASE u % 3 WHEN 0 THEN 'Berlin' WHEN 1 THEN 'Paris' END AS geo_city",
    f"'{TOPIC}' AS source_topic",
    f"CAST(u % {PARTITIONS} AS INT) AS source_partition",
    "n AS source_offset",
]


def to_events(log: DataFrame) -> DataFrame:
    """Raw event columns, with source_topic, source_partition and source_offset."""
    rows = log.selectExpr("event_id AS n", "user_id AS u", "event_type AS type", "value", "props",
                          "unix_millis(CAST(ts AS TIMESTAMP)) AS ms")
    numbered = once(rows, k=F.expr("CAST(get_json_object(props, '$.k') AS BIGINT)"))
    typed = once(numbered, event_type=F.expr(EVENT_TYPE))
    priced = "event_type NOT IN ('search', 'remove_from_cart')"
    return typed.selectExpr(*[c.replace("priced", priced) for c in EVENT_COLUMNS])


def to_messages(log: DataFrame) -> DataFrame:
    """The events as raw messages: JSON bytes, some of them damaged.

    A row whose number divides by 101 lacks two fields, by 107 the country; by 103 its text is cut in
    half, by 109 it ends in a byte that is not UTF-8.
    """
    def body(*without: str) -> str:
        fields = ", ".join(c for c in EVENT_SCHEMA.fieldNames() if c not in without)
        return f"to_json(struct({fields}), map('ignoreNullFields', 'false'))"

    text = (f"CASE WHEN source_offset % 101 = 0 THEN {body('ip_address', 'user_id')}"
            f" WHEN source_offset % 107 = 0 THEN {body('geo_country')} ELSE {body()} END")
    whole = once(to_events(log).select(*SOURCE_COLUMNS, F.expr(text).alias("text")), whole=F.col("text"))
    data = "encode(IF(source_offset % 103 = 0, left(whole, length(whole) div 2), whole), 'UTF-8')"
    return whole.selectExpr(f"concat({data}, IF(source_offset % 109 = 0, X'FF', X'')) AS value", *SOURCE_COLUMNS)
