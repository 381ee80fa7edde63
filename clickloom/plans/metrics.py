"""Queries over aggregated_metrics that a live dashboard shows, and operational counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.config import Settings
from clickloom.functions import clock, text
from clickloom.functions.measures import dollars, row_count
from clickloom.operators import sessions, windows
from clickloom.operators.chain import BOT_REASON
from clickloom.operators.prefix import BLOCK, with_carry
from clickloom.sources.decode import DECODE_REASON

# Lengths of the history, the activity log and the category list, and histogram bounds.
HISTORY = 120
LOG_LINES = 50
BARS = 5
BATCH_SIZE_BOUNDS = [10, 50, 100, 250, 500, 1000]


def newest_first() -> list[Column]:
    return [F.desc("window_end"), F.asc("window_type"), F.asc("window_id")]


def all_window_metrics(events: DataFrame, settings: Settings) -> DataFrame:
    """The three kinds of aggregate in one table."""
    return windows.minute_and_revenue_windows(events, settings).unionByName(
        sessions.session_metrics(events, settings.session_gap_seconds))


def totals(metrics: DataFrame) -> DataFrame:
    """Totals per kind of aggregate, next to the sums over all kinds. An event is counted once per
    kind, so only the rows per kind count events; summed users count a user once per window."""
    rows = metrics.groupBy("window_type").agg(
        F.sum("event_count").alias("events"), F.sum("total_revenue_cents").alias("revenue_cents"),
        F.sum("purchases").alias("purchases"), F.sum("unique_users").alias("summed_users"))
    # One row per kind is left: three rows in all.
    everything = Window.partitionBy(F.lit(1))
    return rows.select(
        "window_type", "events", dollars(F.col("revenue_cents")).alias("revenue_dollars"), "purchases", "summed_users",
        F.sum("events").over(everything).alias("events_all_kinds"),
        dollars(F.sum("revenue_cents").over(everything)).alias("revenue_dollars_all_kinds"),
        F.sum("purchases").over(everything).alias("purchases_all_kinds"),
        F.sum("summed_users").over(everything).alias("summed_users_all_kinds"))


def distinct_users(events: DataFrame) -> DataFrame:
    return events.agg(F.count_distinct("user_id").alias("unique_users"))


def history(metrics: DataFrame, k: int = HISTORY) -> DataFrame:
    return metrics.orderBy(*newest_first()).limit(k)


def latest(metrics: DataFrame) -> DataFrame:
    """The newest aggregate of each kind."""
    newest = F.max_by(F.struct("*"), F.struct("window_end", "window_id"))
    return metrics.groupBy("window_type").agg(newest.alias("m")).select("m.*")


def activity_log(metrics: DataFrame, k: int = LOG_LINES) -> DataFrame:
    """The newest aggregates that hold any events, as log entries."""
    return metrics.where(F.col("event_count") > 0).orderBy(*newest_first()).limit(k).select(
        F.col("window_end").alias("at_ms"), "window_type", "event_count", "unique_users",
        dollars(F.col("total_revenue_cents")).alias("revenue_dollars"))


def running_totals(metrics: DataFrame) -> DataFrame:
    """Totals so far per kind, one row per window start."""
    measures = {"events": "event_count", "revenue_cents": "total_revenue_cents",
                "purchases": "purchases", "summed_users": "unique_users"}
    steps = metrics.groupBy("window_type", "window_start").agg(
        row_count().alias("windows"), *[F.sum(c).alias(name) for name, c in measures.items()])
    names = ["windows", *measures]
    carried = with_carry(steps, ["window_type"], "window_start", clock.HOUR_MS,
                         {f"_{n}": ("sum", F.col(n)) for n in names})
    so_far = Window.partitionBy("window_type", BLOCK).orderBy("window_start")

    def total(name: str) -> Column:
        return F.sum(name).over(so_far) + F.coalesce(f"_{name}", F.lit(0))

    return carried.select(
        "window_type", "window_start", *[total(n).alias(f"total_{n}") for n in names if n != "revenue_cents"],
        dollars(total("revenue_cents")).alias("total_revenue_dollars"))


def throughput(metrics: DataFrame) -> DataFrame:
    """Total events so far and events per second between successive window ends of one kind; 0 for
    the first one."""
    steps = metrics.groupBy("window_type", "window_end").agg(F.sum("event_count").alias("events"))
    carried = with_carry(steps, ["window_type"], "window_end", clock.HOUR_MS,
                         {"_end": ("max", F.col("window_end")), "_events": ("sum", F.col("events"))})
    in_order = Window.partitionBy("window_type", BLOCK).orderBy("window_end")
    elapsed = (F.col("window_end") - F.coalesce(F.lag("window_end").over(in_order), F.col("_end"))) / F.lit(1000.0)
    total = F.sum("events").over(in_order) + F.coalesce("_events", F.lit(0))
    return (carried.withColumns({"elapsed_seconds": elapsed, "total_events": total})
            .select("window_type", "window_end", "events", "total_events", "elapsed_seconds",
                    F.coalesce(F.col("events") / F.col("elapsed_seconds"), F.lit(0.0)).alias("events_per_second")))


def type_distribution(metrics: DataFrame) -> DataFrame:
    """Count and share of the maximum per event type and window. What no counter covers is shown as
    search, never below 0."""
    zero = F.lit(0).cast("long")
    rest = F.col("event_count") - F.col("page_views") - F.col("add_to_carts") - F.col("purchases")
    counts = metrics.where(F.col("event_count") > 0).select(
        "window_id", "window_type", "window_start", F.col("page_views").alias("page_view"),
        F.greatest(rest, zero).alias("search"), F.col("add_to_carts").alias("add_to_cart"),
        F.col("purchases").alias("purchase"), zero.alias("wishlist"))
    names = ["page_view", "search", "add_to_cart", "purchase", "wishlist"]
    top = F.greatest(*names, F.lit(1).cast("long"))
    rows = ", ".join(f"'{n}', {n}" for n in names)
    return counts.withColumn("_top", top).select(
        "window_id", "window_type", "window_start", "_top",
        F.expr(f"stack({len(names)}, {rows}) AS (event_type, count)"),
    ).select("window_id", "window_type", "window_start", "event_type", "count",
             (F.lit(100.0) * F.col("count") / F.col("_top")).alias("pct_of_max"))


def category_bars(metrics: DataFrame, k: int = BARS) -> DataFrame:
    """The ranked categories of each window; the bar shrinks with the rank."""
    shown = F.slice("top_categories", 1, k)
    bars = metrics.select("window_id", "window_type", "window_start", F.size(shown).alias("_n"),
                          F.posexplode(shown).alias("pos", "category"))
    return bars.select(
        "window_id", "window_type", "window_start", (F.col("pos") + 1).alias("rank"), "category",
        (F.lit(100.0) * (F.col("_n") - F.col("pos")) / F.col("_n")).alias("bar_pct"))


def stage_counters(checked: DataFrame, metrics: DataFrame) -> DataFrame:
    """Consumed events by type, failures by stage, dead letters, aggregates by kind."""
    reason = F.col("error_reason")
    failed_stage = (F.when(reason.startswith(DECODE_REASON), F.lit("deserialize"))
                    .when(reason == BOT_REASON, F.lit("bot_filter")).otherwise(F.lit("validate")))
    kinds = checked.groupBy(
        F.when(reason.isNull(), F.lit("events_consumed")).otherwise(F.lit("events_failed")).alias("counter"),
        F.when(reason.isNull(), F.col("event_type")).otherwise(failed_stage).alias("label"),
    ).agg(row_count().alias("value"))
    # The rows below come from a handful of label counts, not from the events again.
    with_dlq = kinds.withColumn("entry", F.when(
        F.col("counter") == "events_failed",
        F.array(F.struct("counter", "label"),
                F.struct(F.lit("events_dlq").alias("counter"), F.lit("all").alias("label"))),
    ).otherwise(F.array(F.struct("counter", "label"))))
    events = (with_dlq.select(F.explode("entry").alias("entry"), "value")
              .groupBy("entry.counter", "entry.label").agg(F.sum("value").alias("value")))
    emitted = metrics.groupBy(F.col("window_type").alias("label")).agg(row_count().alias("value"))
    return events.unionByName(emitted.select(F.lit("aggregations_emitted").alias("counter"), "label", "value"))


def micro_batch_sizes(progress: DataFrame, bounds: list[int] | None = None) -> DataFrame:
    """Histogram of the rows that each micro-batch of the row stream read, from the progress of the streams."""
    read = progress.where("query = 'rows' AND input_rows > 0")
    return batch_size_histogram(read.groupBy(F.col("input_rows").alias("batch_size")).agg(row_count().alias("batches")), bounds)


def batch_size_histogram(batches: DataFrame, bounds: list[int] | None = None) -> DataFrame:
    """Cumulative counts of batches up to each bound, with their number and summed size."""
    bounds = bounds or BATCH_SIZE_BOUNDS
    size, n = F.col("batch_size"), F.col("batches")
    zero = F.lit(0).cast("long")
    totals = batches.agg(
        *[F.coalesce(F.sum(F.when(size <= b, n)), zero).alias(f"le_{b}") for b in bounds],
        F.coalesce(F.sum(n), zero).alias("batch_count"), F.coalesce(F.sum(size * n), zero).alias("row_sum"))
    rows = ", ".join(f"'{b}', le_{b}" for b in bounds) + ", '+Inf', batch_count"
    return totals.select(F.expr(f"stack({len(bounds) + 1}, {rows}) AS (le, batches)"), "batch_count", "row_sum")


def dead_letters_by_class(letters: DataFrame) -> DataFrame:
    return (letters.groupBy(text.reason_class(F.col("error_reason")).alias("reason_class"))
            .agg(row_count().alias("letters")))
