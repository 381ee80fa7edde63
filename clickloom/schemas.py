"""Column layouts of the four tables. Nothing is inferred from data."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Event types and the fields every event has to carry.
EVENT_TYPES = ["page_view", "add_to_cart", "remove_from_cart", "purchase", "search", "wishlist"]
REQUIRED_FIELDS = [
    "event_id", "event_type", "geo_country", "ip_address", "page_url",
    "session_id", "timestamp", "user_agent", "user_id",
]

# Kinds of aggregate.
PER_MINUTE = "events_per_minute"
PER_5_MINUTES = "revenue_per_5min"
SESSION = "session_summary"

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("price_cents", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("search_query", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("geo_country", T.StringType()),
    T.StructField("geo_city", T.StringType()),
])

# Where a raw record came from.
SOURCE_FIELDS = [
    T.StructField("source_topic", T.StringType()),
    T.StructField("source_partition", T.IntegerType()),
    T.StructField("source_offset", T.LongType()),
]
SOURCE_COLUMNS = [f.name for f in SOURCE_FIELDS]
RAW_SCHEMA = T.StructType([T.StructField("value", T.BinaryType()), *SOURCE_FIELDS])

STORED_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_timestamp_ms", T.LongType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("price_cents", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("revenue_cents", T.LongType()),
    T.StructField("search_query", T.StringType()),
    T.StructField("page_url", T.StringType(), False),
    T.StructField("referrer", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("geo_country", T.StringType()),
    T.StructField("geo_city", T.StringType()),
    T.StructField("event_hour", T.IntegerType()),
    T.StructField("is_mobile", T.BooleanType()),
])
STORED_COLUMNS = STORED_SCHEMA.fieldNames()

METRICS_SCHEMA = T.StructType([
    T.StructField("window_id", T.StringType(), False),
    T.StructField("window_type", T.StringType(), False),
    T.StructField("window_start", T.LongType(), False),
    T.StructField("window_end", T.LongType(), False),
    T.StructField("event_count", T.LongType(), False),
    T.StructField("unique_users", T.LongType(), False),
    T.StructField("page_views", T.LongType()),
    T.StructField("add_to_carts", T.LongType()),
    T.StructField("purchases", T.LongType()),
    T.StructField("total_revenue_cents", T.LongType()),
    T.StructField("top_products", T.ArrayType(T.StringType())),
    T.StructField("top_categories", T.ArrayType(T.StringType())),
])
METRICS_COLUMNS = METRICS_SCHEMA.fieldNames()

DEAD_LETTER_SCHEMA = T.StructType([
    T.StructField("original_payload", T.StringType()),
    T.StructField("error_reason", T.StringType(), False),
    *SOURCE_FIELDS,
    T.StructField("failed_at", T.LongType()),
    T.StructField("failed_at_iso", T.StringType()),
])

# Key and NOT NULL columns per stored table.
TABLE_KEYS = {
    "clickstream_events": ["event_id"],
    "aggregated_metrics": ["window_id"],
    "dead_letter_events": SOURCE_COLUMNS,
}
TABLE_SCHEMAS = {
    "clickstream_events": STORED_SCHEMA,
    "aggregated_metrics": METRICS_SCHEMA,
    "dead_letter_events": DEAD_LETTER_SCHEMA,
}


# Defaults in the Avro schemas.
AVRO_DEFAULTS = {"geo_country": "US", "page_views": 0, "add_to_carts": 0, "purchases": 0, "total_revenue_cents": 0,
                 "top_products": [], "top_categories": []}
AVRO_TYPES = {"string": "string", "bigint": "long", "int": "int", "array<string>": {"type": "array", "items": "string"}}


def avro_schema(schema: T.StructType, name: str, enum: str, symbols: list[str]) -> str:
    """The Avro record schema of a table layout, as JSON text; `enum` is the column with fixed symbols.
    Nullable columns become unions with null."""
    fields = []
    for f in schema.fields:
        kind = AVRO_TYPES[f.dataType.simpleString()]
        if f.name == enum:
            kind = {"type": "enum", "name": "".join(w.title() for w in enum.split("_")), "symbols": symbols}
        field = {"name": f.name, "type": ["null", kind] if f.nullable else kind}
        if f.nullable or f.name in AVRO_DEFAULTS:
            field["default"] = None if f.nullable else AVRO_DEFAULTS[f.name]
        fields.append(field)
    return json.dumps({"type": "record", "name": name, "namespace": "clickloom", "fields": fields})


EVENT_AVRO = avro_schema(
    T.StructType([T.StructField(f.name, f.dataType, f.name not in REQUIRED_FIELDS) for f in EVENT_SCHEMA.fields]),
    "ClickstreamEvent", "event_type", EVENT_TYPES)
METRICS_AVRO = avro_schema(
    T.StructType([*[T.StructField(f.name, f.dataType, False) for f in METRICS_SCHEMA.fields],
                  T.StructField("emitted_at", T.LongType(), False)]),
    "AggregatedMetrics", "window_type", [PER_MINUTE, PER_5_MINUTES, SESSION])
