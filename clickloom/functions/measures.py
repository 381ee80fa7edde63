"""Aggregate expressions shared by windows, sessions and reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The measures of a window or session that add up.
ADDITIVE = ["event_count", "page_views", "add_to_carts", "purchases", "total_revenue_cents"]


def row_count() -> Column:
    return F.count(F.lit(1))


def is_type(name: str) -> Column:
    return F.col("event_type") == name


def event_measures() -> list[Column]:
    """The additive measures, from events."""
    return [
        F.expr("count(*) AS event_count"),
        F.expr("count_if(event_type = 'page_view') AS page_views"),
        F.expr("count_if(event_type = 'add_to_cart') AS add_to_carts"),
        F.expr("count_if(event_type = 'purchase') AS purchases"),
        F.expr("coalesce(sum(IF(event_type = 'purchase', revenue_cents, NULL)), 0) AS total_revenue_cents"),
    ]


def summed_measures() -> list[Column]:
    """The additive measures, from rows that already hold them."""
    return [F.expr(f"sum({name}) AS {name}") for name in ADDITIVE]


def dollars(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def mean_dollars(cents: Column) -> Column:
    return F.sum(cents).cast("double") / F.count(cents) / F.lit(100.0)


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole in decimal arithmetic, rounded half up; null when whole is 0."""
    ratio = F.lit(Decimal("100.0")) * part / F.nullif(whole, F.lit(0).cast("long"))
    return F.round(ratio, digits).cast("double")

