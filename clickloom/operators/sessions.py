"""Sessions per (user, session id), split where the pause exceeds the gap.

Events are first combined into slices as long as the gap. Two events of one slice are never further
apart than the gap, so a slice never spans a split, and the work left per key is bounded by its time
span divided by the gap, however many events the key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.config import Settings
from clickloom.functions import clock
from clickloom.functions.measures import event_measures, summed_measures
from clickloom.schemas import METRICS_COLUMNS, SESSION

KEY = ["user_id", "session_id"]
# What sessions with and without some rows are made of.
INPUT = [*KEY, "event_id", "timestamp", "event_type", "revenue_cents"]


def _islands(events: DataFrame, gap_seconds: int, measures: list[Column]) -> DataFrame:
    """Slices with the start of the session they belong to; `_start` is set on the first of each."""
    gap = gap_seconds * 1000
    slices = events.groupBy(*KEY, F.expr(f"timestamp - pmod(timestamp, {gap}L) AS slice")).agg(
        F.expr("min(timestamp) AS first_ms"), F.expr("max(timestamp) AS last_ms"), *measures)
    in_order = "OVER (PARTITION BY user_id, session_id ORDER BY slice)"
    starts = f"CASE WHEN first_ms - lag(last_ms) {in_order} <= {gap} THEN NULL ELSE first_ms END"
    return (slices.withColumn("_start", F.expr(starts))
            .withColumn("window_start", F.expr(f"last_value(_start) IGNORE NULLS {in_order}")))


def session_rows(sessions: DataFrame, *more: str) -> DataFrame:
    """Sessions, one row each with start, end and additive measures, in the layout of
    aggregated_metrics, after their key columns; `more` columns come last."""
    made = {
        "window_type": f"'{SESSION}' AS window_type",
        "window_id": f"md5(concat_ws('|', '{SESSION}', window_start, user_id, session_id)) AS window_id",
        "unique_users": "1L AS unique_users",
        "top_products": "CAST(array() AS array<string>) AS top_products",
        "top_categories": "CAST(array() AS array<string>) AS top_categories",
    }
    return sessions.selectExpr(*KEY, *[made.get(name, name) for name in METRICS_COLUMNS], *more)


def sessions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """One row per session: start, time of the last event, measures, and the key columns."""
    found = _islands(events, gap_seconds, event_measures()).groupBy(*KEY, "window_start").agg(
        F.max("last_ms").alias("window_end"), *summed_measures())
    return session_rows(found)


def session_metrics(events: DataFrame, gap_seconds: int) -> DataFrame:
    return sessions(events, gap_seconds).select(METRICS_COLUMNS)


def open_sessions(events: DataFrame, as_of: int | Column, settings: Settings) -> DataFrame:
    """How many sessions may still grow.

    A session is open as long as its last event lies within gap and lateness. Its events in that
    horizon stay one run, so only the horizon is read.
    """
    horizon = F.lit((settings.session_gap_seconds + settings.lateness_seconds) * 1000).cast("long")
    recent = events.where(F.col("timestamp") > clock.as_millis(as_of) - horizon)
    runs = _islands(recent, settings.session_gap_seconds, [])
    return runs.agg(F.count("_start").alias("open_sessions"))
