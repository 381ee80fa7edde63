"""Tumbling windows: counts, exact unique users, revenue, top products and categories.

Two stages. Stage 1 counts per (window, user) and per (window, product or category): the keys
spread over the cluster, and Spark combines rows before it shuffles them, so neither a busy window
nor a busy key meets in one task. Stage 2 folds those rows into one row per window; its ranking is
`row_number() <= k`, which Spark also cuts to k rows per window before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.config import Settings
from clickloom.functions import clock
from clickloom.functions.measures import event_measures, summed_measures
from clickloom.schemas import METRICS_COLUMNS, PER_5_MINUTES, PER_MINUTE

# Lengths of the two top lists.
TOP_PRODUCTS = 10
TOP_CATEGORIES = 5

PRODUCT, CATEGORY = "product", "category"


def window_start(column: str, seconds: int) -> Column:
    """Start of the window a time lies in. Valid rows have a time, so the start is never null; saying
    so keeps the plans of short and long windows alike, and Spark counts the events for both once."""
    return F.expr(f"coalesce({column} - pmod({column}, {seconds * 1000}L), 0L) AS window_start")


def facet(name: str, column: str) -> str:
    return f"struct('{name}' AS facet, {column} AS key)"


def user_counts(events: DataFrame, seconds: int) -> DataFrame:
    """One row per (window_start, user_id) with the additive measures."""
    return events.groupBy(window_start("timestamp", seconds), "user_id").agg(*event_measures())


def item_counts(events: DataFrame, seconds: int) -> DataFrame:
    """One row per (window_start, facet, key): how often, and when first. Null and blank keys are left out."""
    facets = F.expr(f"inline(array({facet(PRODUCT, 'product_id')}, {facet(CATEGORY, 'product_category')}))")
    items = events.select("timestamp", window_start("timestamp", seconds), facets).where("key != ''")
    return items.groupBy("window_start", "facet", "key").agg(F.expr("count(*) AS n"), F.expr("min(timestamp) AS first_ms"))


def coarsen_users(users: DataFrame, seconds: int) -> DataFrame:
    return users.groupBy(window_start("window_start", seconds), "user_id").agg(*summed_measures())


def coarsen_items(items: DataFrame, seconds: int) -> DataFrame:
    return items.groupBy(window_start("window_start", seconds), "facet", "key").agg(
        F.expr("sum(n) AS n"), F.expr("min(first_ms) AS first_ms"))


def rank_items(items: DataFrame, k: int) -> DataFrame:
    """The k most frequent keys per window and facet; ties go to the earlier first event, then by key."""
    rank = "row_number() OVER (PARTITION BY window_start, facet ORDER BY n DESC, first_ms, key)"
    return items.withColumn("rank", F.expr(rank)).where(f"rank <= {k}")


def top_lists(items: DataFrame) -> DataFrame:
    """One row per window with the arrays top_products and top_categories."""
    ranked = rank_items(items, max(TOP_PRODUCTS, TOP_CATEGORIES))

    def ordered(facet: str, k: int) -> str:
        # At most k entries per window reach the list: the rows were cut by rank before.
        entries = f"collect_list(struct(rank, key)) FILTER (WHERE facet = '{facet}' AND rank <= {k})"
        return f"transform(array_sort({entries}), e -> e.key)"

    return ranked.groupBy("window_start").agg(
        F.expr(ordered(PRODUCT, TOP_PRODUCTS) + " AS top_products"),
        F.expr(ordered(CATEGORY, TOP_CATEGORIES) + " AS top_categories"))


def fold(users: DataFrame, items: DataFrame, window_type: str, seconds: int) -> DataFrame:
    """Stage 2: rows in the layout of aggregated_metrics."""
    measures = users.groupBy("window_start").agg(F.expr("count(*) AS unique_users"), *summed_measures())
    made = {
        "window_type": f"'{window_type}' AS window_type",
        "window_end": f"window_start + {seconds * 1000}L AS window_end",
        "window_id": f"md5(concat_ws('|', '{window_type}', window_start)) AS window_id",
        "top_products": "coalesce(top_products, CAST(array() AS array<string>)) AS top_products",
        "top_categories": "coalesce(top_categories, CAST(array() AS array<string>)) AS top_categories",
    }
    joined = measures.join(top_lists(items), "window_start", "left")
    return joined.selectExpr(*[made.get(name, name) for name in METRICS_COLUMNS])


def tumbling(events: DataFrame, seconds: int, window_type: str) -> DataFrame:
    return fold(user_counts(events, seconds), item_counts(events, seconds), window_type, seconds)


def minute_and_revenue_windows(events: DataFrame, settings: Settings) -> DataFrame:
    """Both window kinds. The longer windows are put together from the shorter ones where they nest,
    so the events are counted once."""
    short, long = settings.minute_seconds, settings.revenue_seconds
    users, items = user_counts(events, short), item_counts(events, short)
    if long % short == 0:
        long_users, long_items = coarsen_users(users, long), coarsen_items(items, long)
    else:
        long_users, long_items = user_counts(events, long), item_counts(events, long)
    return fold(users, items, PER_MINUTE, short).unionByName(fold(long_users, long_items, PER_5_MINUTES, long))


def closed(metrics: DataFrame, as_of: int | Column, lateness_seconds: int, gap_seconds: int = 0) -> DataFrame:
    """Windows whose end, plus the gap for sessions, plus the lateness has passed."""
    margin = F.lit((lateness_seconds + gap_seconds) * 1000).cast("long")
    return metrics.where(F.col("window_end") + margin <= clock.as_millis(as_of))


def open_windows(events: DataFrame, as_of: int | Column, settings: Settings) -> DataFrame:
    """How many windows of each kind are still open. Only the last minutes of the events are read."""
    now = clock.as_millis(as_of)
    late = settings.lateness_seconds * 1000

    def count(window_type: str, seconds: int) -> DataFrame:
        size = seconds * 1000
        recent = events.where(F.col("timestamp") > now - F.lit(late + size).cast("long"))
        starts = recent.select(clock.floor_to(F.col("timestamp"), size).alias("window_start"))
        still_open = F.col("window_start") + F.lit(size + late).cast("long") > now
        return starts.where(still_open).agg(F.count_distinct("window_start").alias("open_windows")).select(
            F.lit(window_type).alias("window_type"), "open_windows")

    return count(PER_MINUTE, settings.minute_seconds).unionByName(count(PER_5_MINUTES, settings.revenue_seconds))


def restate(events: DataFrame, late: DataFrame, seconds: int, window_type: str) -> DataFrame:
    """Windows that rows in `late` belong to, computed again from all stored events of those windows."""
    start = clock.floor_to(F.col("timestamp"), seconds * 1000)
    touched = late.select(start.alias("_start")).distinct()
    again = events.withColumn("_start", start).join(touched, "_start", "left_semi").drop("_start")
    return tumbling(again, seconds, window_type)
