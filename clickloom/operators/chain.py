"""Row-level chain: validate, set bots aside, normalize, enrich. First failing rule wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import clock, text
from clickloom.functions.barrier import once
from clickloom.schemas import EVENT_TYPES, REQUIRED_FIELDS, STORED_COLUMNS

# Parts of a user agent that mark bots and mobile devices.
BOT_MARKS = ["bot", "crawler", "spider", "scrapy", "curl", "wget", "httpx"]
MOBILE_MARKS = ["mobile", "iphone", "android", "ipad"]
BOT_REASON = "Filtered as bot traffic"

# A field may be null without being missing where a later rule reports it or a default fills it.
NULL_IS_MISSING = [f for f in REQUIRED_FIELDS if f not in ("event_type", "timestamp", "geo_country")]


# (what has to hold, reason if it does not) for the values of a row, in order.
VALUE_RULES = [
    ("event_type IN ({})".format(", ".join(f"'{t}'" for t in EVENT_TYPES)),
     "concat('Invalid event_type: ', coalesce(event_type, 'None'))"),
    (f"timestamp > 0 AND timestamp <= {clock.MAX_MS}",
     "concat('Invalid timestamp: ', coalesce(CAST(timestamp AS STRING), 'None'))"),
    ("event_type != 'purchase' OR coalesce(price_cents, 0) >= 0", "concat('Negative price_cents: ', price_cents)"),
    ("event_type != 'purchase' OR coalesce(quantity, 1) > 0", "concat('Invalid quantity: ', quantity)"),
    ("event_type != 'purchase' OR try_multiply(coalesce(price_cents, 0), coalesce(quantity, 0)) IS NOT NULL",
     "concat('Revenue out of range: ', price_cents, ' * ', quantity)"),
]


def missing_keys(json_text: Column) -> Column:
    """Required fields that are not keys of a JSON object, in alphabetical order."""
    required = F.expr("array({})".format(", ".join(f"'{f}'" for f in REQUIRED_FIELDS)))
    return F.array_except(required, F.json_object_keys(json_text))


def missing_reason(with_absent: bool) -> str:
    """SQL of the reason if a required field is absent or null, else null."""
    def listed(names: str) -> str:
        return f"concat('Missing required fields: [\\'', array_join(array_sort({names}), '\\', \\''), '\\']')"

    nulls = ", ".join(f"IF({name} IS NULL, '{name}', NULL)" for name in NULL_IS_MISSING)
    nulls = f"array_compact(array({nulls}))"
    any_null = " OR ".join(f"{name} IS NULL" for name in NULL_IS_MISSING)
    first = f"WHEN size(absent_fields) > 0 THEN {listed(f'array_union(absent_fields, {nulls})')}" if with_absent else ""
    return f"CASE {first} WHEN {any_null} THEN {listed(nulls)} END"


def has_agent(events: DataFrame) -> DataFrame:
    """Add `_agent`, the lower-case user agent, which the bot and the mobile test search several times."""
    if "_agent" in events.columns:
        return events
    return once(events, _agent=F.lower(F.coalesce("user_agent", F.lit(""))))


def is_bot() -> Column:
    return text.contains_any("_agent", BOT_MARKS)


def validate(events: DataFrame) -> DataFrame:
    """Add `error_reason`: what is wrong with a row, null for a valid one.

    Rows decoded from text bring `decode_error` and `absent_fields`, which come first.
    """
    reasons = [missing_reason("absent_fields" in events.columns)]
    reasons += [f"IF(coalesce({holds}, false), NULL, {reason})" for holds, reason in VALUE_RULES]
    if "decode_error" in events.columns:
        reasons.insert(0, "decode_error")
    return events.withColumn("error_reason", F.expr(f"coalesce({', '.join(reasons)})"))


def only_valid(events: DataFrame) -> DataFrame:
    """The rows that `validate` finds nothing wrong with. Plain conditions, which reach the scan."""
    conditions = [f"{name} IS NOT NULL" for name in NULL_IS_MISSING] + [holds for holds, _ in VALUE_RULES]
    if "absent_fields" in events.columns:
        conditions.append("size(absent_fields) = 0")
    if "decode_error" in events.columns:
        conditions.append("decode_error IS NULL")
    return events.where(" AND ".join(f"({c})" for c in conditions))


def mark_bots(events: DataFrame) -> DataFrame:
    """Give valid rows of bots and crawlers their reason."""
    reason = F.coalesce(F.col("error_reason"), F.when(is_bot(), F.lit(BOT_REASON)))
    return has_agent(events).withColumn("error_reason", reason)


def filter_bots(events: DataFrame) -> DataFrame:
    return _people(events).drop("_agent")


def _people(events: DataFrame) -> DataFrame:
    return has_agent(events).where(~is_bot())


def normalize(events: DataFrame) -> DataFrame:
    country = text.strip(F.upper("geo_country"))
    return events.withColumns({
        "geo_country": F.coalesce(F.nullif(country, F.lit("")), F.lit("UNKNOWN")),
        "search_query": F.lower(text.strip(F.col("search_query"))),
    })


def enrich(events: DataFrame) -> DataFrame:
    revenue = "IF(event_type = 'purchase', coalesce(price_cents, 0) * coalesce(CAST(quantity AS BIGINT), 0), 0)"
    return has_agent(events).withColumns({
        "revenue_cents": F.expr(revenue),
        "event_hour": clock.hour_of_day(F.col("timestamp")),
        "is_mobile": text.contains_any("_agent", MOBILE_MARKS),
    }).drop("_agent")


def checked(events: DataFrame) -> DataFrame:
    """All rows with `error_reason`, to be split into accepted and rejected ones."""
    return events.transform(validate).transform(mark_bots)


def accepted(checked_events: DataFrame) -> DataFrame:
    return checked_events.where(F.col("error_reason").isNull()).drop("error_reason", "decode_error", "absent_fields")


def rejected(checked_events: DataFrame) -> DataFrame:
    return checked_events.where(F.col("error_reason").isNotNull()).drop("_agent")


def refine(good: DataFrame) -> DataFrame:
    """Normalize and enrich accepted rows."""
    return good.transform(normalize).transform(enrich)


def process(events: DataFrame) -> DataFrame:
    """The whole chain where only the good rows are wanted: no reasons are worked out."""
    good = events.transform(only_valid).transform(_people).drop("decode_error", "absent_fields")
    return refine(good)


def to_stored(processed: DataFrame) -> DataFrame:
    """Processed rows in the layout of the table clickstream_events."""
    renamed = processed.withColumnRenamed("timestamp", "event_timestamp_ms")
    return renamed.withColumn("revenue_cents", F.coalesce("revenue_cents", F.lit(0).cast("long"))).select(STORED_COLUMNS)


def from_stored(stored: DataFrame) -> DataFrame:
    """Rows of clickstream_events as processed rows, for windows and sessions."""
    return stored.withColumnRenamed("event_timestamp_ms", "timestamp")
