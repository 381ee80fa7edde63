"""Distinct users and frequent products per window as sketches, which can be united over any span.

Summed users of windows count a user once per window, and top lists of windows do not add up to that of a day. The sketches kept
here do: one row per window holds a HyperLogLog sketch of its users, one of its products, and a frequent-items sketch of its
products. None of them grows beyond a fixed size, whatever the window holds.

`refresh` brings them up to date with the stored events. A row tells which events it holds, by their number and fingerprint (see
marks.py), so only windows whose stored events differ are counted again, and a refresh that breaks off or runs twice changes
nothing. A window for which a write of events broke off is counted again each time, until that write is repeated or restated.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.functions.measures import row_count
from clickloom.session import shared_dir
from clickloom.sinks.marks import MINUTE_MS, row_mark, window_item
from clickloom.sinks.tables import EVENTS, Tables

# 2 ** PRECISION registers in a sketch of distinct values: 4 KB at most.
PRECISION = 12
# Four standard errors of such a sketch after uniting (1.04 / sqrt(registers) each).
RELATIVE_BOUND = 4 * 1.04 / 2 ** (PRECISION / 2)
# Products that a sketch of frequent products can tell apart and count exactly.
TRACKED = 3_000

WINDOW_SKETCHES = "window_sketches"
SCHEMA = (
    "window_start long, event_count long, mark long, users binary, product_events long, products_seen binary, products "
    "struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>, window_date date")


def sketched(tracked: int = TRACKED) -> list[Column]:
    """The sketches of a group of events, and the number of its events with a product."""
    named = "FILTER (WHERE product_id != '')"
    return [F.expr(f"hll_sketch_agg(user_id, {PRECISION}) AS users"),
            F.expr(f"count(*) {named} AS product_events"),
            F.expr(f"hll_sketch_agg(product_id, {PRECISION}) {named} AS products_seen"),
            F.expr(f"approx_top_k_accumulate(product_id, {tracked}) {named} AS products")]


def per_window(events: DataFrame, size_ms: int = MINUTE_MS, tracked: int = TRACKED) -> DataFrame:
    """One row of sketches per window of rows in the layout of clickstream_events. Spark fills a sketch per task and window
    before it shuffles them. Null and blank products are left out, as in the top lists."""
    time = "event_timestamp_ms"
    found = events.groupBy(clock.floor_to(F.col(time), size_ms).alias("window_start")).agg(
        row_count().alias("event_count"), F.bit_xor(row_mark(time)).alias("mark"), *sketched(tracked))
    return found.withColumn("window_date", clock.utc_date(F.col("window_start")))


def united(sketches: DataFrame, span_ms: int = clock.DAY_MS, tracked: int = TRACKED) -> DataFrame:
    """Sketches of spans, put together from those of the windows that start in them; `tracked` as in per_window."""
    return sketches.groupBy(clock.floor_to(F.col("window_start"), span_ms).alias("window_start")).agg(
        F.sum("event_count").alias("event_count"), F.expr("hll_union_agg(users) AS users"),
        F.sum("product_events").alias("product_events"), F.expr("hll_union_agg(products_seen) AS products_seen"),
        F.expr(f"approx_top_k_combine(products, {tracked}) AS products"))


def users_by_span(sketches: DataFrame, span_ms: int = clock.DAY_MS) -> DataFrame:
    """Estimated distinct users per span, and how far the exact number may be from it (four standard errors)."""
    found = united(sketches, span_ms).withColumn("estimated_users", F.hll_sketch_estimate("users"))
    return found.select("window_start", "event_count", "estimated_users", error_bound(F.col("estimated_users")).alias("error_bound"))


def error_bound(estimate: Column) -> Column:
    return F.ceil(estimate * F.lit(RELATIVE_BOUND)).cast("long")


def top_products_by_span(sketches: DataFrame, span_ms: int = clock.DAY_MS, k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The k most frequent products per span: rank, product, count, and by how much the count may be too high.

    The bound is 0 where the sketch has had room for all products of the span; ties go by key. Elsewhere it is the
    guarantee of the sketch, 3.5 / slots of all counted events, and a product above it cannot be missing.
    """
    found = united(sketches, span_ms, tracked).selectExpr(
        "window_start", "product_events", "hll_sketch_estimate(products_seen) AS seen",
        f"approx_top_k_estimate(products, {tracked}) AS entries")
    # Nothing was ever thrown out if all counts are there and the products, as many as they may be, fit in.
    whole = ((F.col("seen") + error_bound(F.col("seen")) <= F.lit(tracked))
             & F.expr("aggregate(entries, 0L, (total, e) -> total + e.count) = product_events"))
    slots = 2 ** (-(-4 * tracked // 3) - 1).bit_length()
    bound = F.when(whole, F.lit(0)).otherwise(F.ceil(F.col("product_events") * F.lit(3.5 / slots))).cast("long")
    items = found.select("window_start", bound.alias("error_bound"), F.expr("inline(entries)"))
    rank = "row_number() OVER (PARTITION BY window_start ORDER BY count DESC, item)"
    return (items.withColumn("rank", F.expr(rank)).where(F.col("rank") <= k)
            .select("window_start", "rank", F.col("item").alias("product_id"), F.col("count").alias("n"), "error_bound"))


def read_windows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The windows stored at a path, none before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_windows(stored: DataFrame, rows: DataFrame, dates: list, path: str) -> None:
    """Write `rows` in place of the stored windows that start with them. Only the days in `dates`, those of the rows, are written
    again, a file each."""
    kept = stored.where(F.col("window_date").isin(dates)).join(rows.select("window_start"), "window_start", "left_anti")
    # The days are read and overwritten: their new content has to be complete before.
    whole = kept.unionByName(rows.select(kept.columns)).checkpoint()
    (whole.repartition("window_date").sortWithinPartitions("window_date", "window_start")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_date").parquet(path))


class Sketches:
    """The sketches beside the tables of one root folder, partitioned by date. `size_ms` belongs to the stored layout."""

    def __init__(self, tables: Tables, size_ms: int = MINUTE_MS) -> None:
        if size_ms % MINUTE_MS or clock.DAY_MS % size_ms:
            raise ValueError("windows of sketches are whole minutes that divide a day")
        self.tables = tables
        self.size_ms = size_ms
        self.path = tables.path(WINDOW_SKETCHES)

    def read(self) -> DataFrame:
        return read_windows(self.tables.spark, self.path, SCHEMA)

    def differing(self, since: int = 0) -> DataFrame:
        """Starts of the windows whose stored events are not those that their sketches hold; neither events nor sketches are read."""
        date = clock.utc_date(F.lit(since))
        marks = self.tables.marks.stored("minute", self.tables.stored(EVENTS)).where(F.col("event_date") >= date)
        stored = marks.groupBy(window_item(self.size_ms).alias("window_start")).agg(F.sum("n").alias("n"), F.bit_xor("mark").alias("now"))
        held = self.read().where(F.col("window_date") >= date).select("window_start", "event_count", "mark")
        return stored.join(held, "window_start", "left").where(
            "event_count IS NULL OR event_count != n OR mark != now").select("window_start")

    def refresh(self, since: int = 0) -> None:
        """Count the differing windows again; of the events their dates are read, of the sketches their dates written."""
        shared_dir(self.tables.spark)
        found = self.differing(since).checkpoint()
        dates = [r[0] for r in found.select(clock.utc_date(F.col("window_start"))).distinct().collect()]  # one per day
        if not dates:
            return
        ends = found.agg(F.min("window_start"), F.max("window_start")).first()
        time = F.col("event_timestamp_ms")
        near = (self.tables.events().where(F.col("event_date").isin(dates)).where(time.between(ends[0], ends[1] + self.size_ms - 1))
                .withColumn("window_start", clock.floor_to(time, self.size_ms)).join(found, "window_start", "left_semi"))
        replace_windows(self.read(), per_window(near, self.size_ms).checkpoint(), dates, self.path)
