"""The ten reports over the stored tables. Every limit has a full order, so results do not vary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.functions.measures import dollars, is_type, mean_dollars, percentage, row_count
from clickloom.functions.text import reason_class

MS = "event_timestamp_ms"


def _since(events: DataFrame, as_of: int | Column | None, span_ms: int) -> DataFrame:
    """Rows of the last `span_ms`. The bound is on the stored column, so it reaches the scan; on a
    table partitioned by event_date, so does the date."""
    bound = clock.as_millis(as_of) - F.lit(span_ms).cast("long")
    recent = events.where(F.col(MS) > bound)
    if "event_date" in events.columns:
        recent = recent.where(F.col("event_date") >= clock.utc_date(bound))
    return recent


def _revenue() -> Column:
    return dollars(F.sum("revenue_cents"))


def events_over_time(
    events: DataFrame, as_of: int | Column | None = None, span_ms: int = clock.HOUR_MS, grain: str = "minute",
) -> DataFrame:
    """Events and users per minute (or second) in the last hour, newest first."""
    size = {"second": 1_000, "minute": 60_000}[grain]
    bucket = F.timestamp_millis(clock.floor_to(F.col(MS), size)).alias("event_minute")
    return (_since(events, as_of, span_ms).groupBy(bucket)
            .agg(row_count().alias("event_count"), F.count_distinct("user_id").alias("unique_users"))
            .orderBy(F.desc("event_minute")))


def revenue_by_category(
    events: DataFrame, as_of: int | Column | None = None, span_ms: int = clock.DAY_MS,
) -> DataFrame:
    purchases = _since(events.where(is_type("purchase")), as_of, span_ms)
    return (purchases.groupBy("product_category")
            .agg(row_count().alias("purchase_count"), _revenue().alias("total_revenue_dollars"),
                 mean_dollars(F.col("revenue_cents")).alias("avg_order_value_dollars"))
            .orderBy(F.desc_nulls_first("total_revenue_dollars"), "product_category"))


def funnel(events: DataFrame) -> DataFrame:
    """Event counts of the three stages and their share of the page views, from one scan."""
    stages = ["page_view", "add_to_cart", "purchase"]
    counts = events.agg(*[F.count_if(is_type(s)).alias(s) for s in stages])
    views = F.col("page_view")
    shares = counts.select(
        "*", F.lit(100.0).alias("pct_page_view"),
        *[percentage(F.col(s), views, 1).alias(f"pct_{s}") for s in stages[1:]])
    rows = ", ".join(f"'{s}', {s}, pct_{s}" for s in stages)
    return shares.select(F.expr(f"stack(3, {rows}) AS (stage, count, pct)"))


def top_products(events: DataFrame, k: int = 10) -> DataFrame:
    return (events.where(F.col("product_id").isNotNull()).groupBy("product_id", "product_category")
            .agg(row_count().alias("interactions"), F.count_if(is_type("purchase")).alias("purchases"),
                 _revenue().alias("revenue_dollars"))
            .orderBy(F.desc("interactions"), "product_id", F.asc_nulls_first("product_category"))
            .limit(k))


def session_depth(events: DataFrame, k: int = 20) -> DataFrame:
    """The longest sessions with more than one event, by stored session id."""
    return (events.groupBy("session_id", "user_id")
            .agg(row_count().alias("events_in_session"),
                 ((F.max(MS) - F.min(MS)) / F.lit(1000.0)).alias("session_duration_seconds"),
                 F.count_distinct("page_url").alias("unique_pages"),
                 F.bool_or(is_type("purchase")).alias("converted"))
            .where(F.col("events_in_session") > 1)
            .orderBy(F.desc("session_duration_seconds"), "session_id", "user_id")
            .limit(k))


def geography(events: DataFrame, k: int = 15) -> DataFrame:
    return (events.groupBy("geo_country", "geo_city")
            .agg(row_count().alias("events"), F.count_distinct("user_id").alias("unique_users"),
                 _revenue().alias("revenue_dollars"))
            .orderBy(F.desc("events"), "geo_country", F.asc_nulls_first("geo_city"))
            .limit(k))


def mobile_conversion(events: DataFrame) -> DataFrame:
    """Purchase rate by device. Rows of unknown device stay a group of their own, printed as Desktop."""
    counts = events.groupBy("is_mobile").agg(
        row_count().alias("total_events"), F.count_if(is_type("purchase")).alias("purchases"))
    return counts.select(
        F.when(F.col("is_mobile"), F.lit("Mobile")).otherwise(F.lit("Desktop")).alias("platform"),
        "total_events", "purchases",
        percentage(F.col("purchases"), F.col("total_events"), 2).alias("purchase_rate_pct"))


def hourly(events: DataFrame) -> DataFrame:
    return (events.groupBy("event_hour")
            .agg(row_count().alias("events"), F.count_distinct("user_id").alias("unique_users"),
                 _revenue().alias("revenue_dollars"))
            .orderBy("event_hour"))


def dead_letter_reasons(letters: DataFrame) -> DataFrame:
    seen = F.timestamp_seconds(F.floor(F.col("failed_at") / F.lit(1000)))
    return (letters.groupBy("error_reason")
            .agg(row_count().alias("error_count"), F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"))
            .withColumn("reason_class", reason_class(F.col("error_reason")))
            .orderBy(F.desc("error_count"), "error_reason"))


def window_history(metrics: DataFrame, k: int = 20) -> DataFrame:
    return (metrics.orderBy(F.desc("window_start"), "window_type", "window_id").limit(k)
            .select("window_type",
                    F.timestamp_seconds(F.floor(F.col("window_start") / F.lit(1000))).alias("window_start_ts"),
                    F.timestamp_seconds(F.floor(F.col("window_end") / F.lit(1000))).alias("window_end_ts"),
                    "event_count", "unique_users", "purchases",
                    dollars(F.col("total_revenue_cents")).alias("revenue_dollars"),
                    F.slice("top_categories", 1, 3).alias("top_3_categories")))
