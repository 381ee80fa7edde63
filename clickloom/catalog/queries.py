"""Every operator as a named query over the activity log in a data folder.

Results hold scalars and text only, so that another engine can be compared: arrays are joined with
commas, times printed as UTC.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import jobs as batch
from clickloom.config import Settings
from clickloom.functions import clock
from clickloom.functions.measures import ADDITIVE
from clickloom.operators import chain, constraints, dead_letters, late, windows
from clickloom.operators import sessions as session_ops
from clickloom.operators.dedupe import first_per_key, not_stored
from clickloom.plans import metrics, reports
from clickloom.schemas import (
    EVENT_SCHEMA, METRICS_COLUMNS, METRICS_SCHEMA, PER_5_MINUTES, PER_MINUTE, SOURCE_COLUMNS, STORED_COLUMNS,
)
from clickloom.session import fresh_dir, prepare
from clickloom.sinks import messages, sketches
from clickloom.sinks.tables import DEAD_LETTERS, EVENTS, Tables
from clickloom.sources import activity_log, decode, topics
from clickloom.streaming import jobs, updates
from clickloom.streaming.progress import ProgressLog

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = Settings()
# The log has few events per user; a longer gap gives sessions of several events.
LONG_GAP = dataclasses.replace(SETTINGS, session_gap_seconds=21_600)
# Every 211th event arrives this many events late.
ARRIVAL_DELAY = 1_000
# Messages per file, about. A file is read by one task, whatever the number of messages in a micro-batch.
MESSAGES_PER_FILE = 50_000

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# --- inputs -------------------------------------------------------------------------------------

def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_log.to_events(activity_log.read_log(spark, sf_dir))


def good_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.process(raw_events(spark, sf_dir))


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.to_stored(good_events(spark, sf_dir))


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_json(activity_log.to_messages(activity_log.read_log(spark, sf_dir)))


def dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the damaged messages."""
    return dead_letters.envelope(chain.rejected(chain.checked(decoded(spark, sf_dir))))


def window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.all_window_metrics(good_events(spark, sf_dir), SETTINGS)


def newest_ms(good: DataFrame) -> Column:
    """The newest event time, a subquery of one row in the plan that uses it."""
    return good.agg(F.max("timestamp")).scalar()


def flat(df: DataFrame) -> DataFrame:
    """Arrays joined, times printed."""
    def shown(name: str, kind: str):
        if kind.startswith("array"):
            return F.array_join(name, ",").alias(name)
        if kind == "timestamp":
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        return F.col(name)

    return df.select([shown(*pair) for pair in df.dtypes])


# --- decode, validate, route ----------------------------------------------------------------------

@query
def decode_json_events(spark, sf_dir):
    return flat(decoded(spark, sf_dir).drop("value"))


@query
def validate_required_json(spark, sf_dir):
    events = chain.validate(decoded(spark, sf_dir))
    return events.where(F.size("absent_fields") > 0).select(*SOURCE_COLUMNS, "error_reason")


@query
def validate_events(spark, sf_dir):
    return chain.validate(raw_events(spark, sf_dir)).select("event_id", "event_type", "error_reason")


@query
def filter_bots(spark, sf_dir):
    return chain.filter_bots(raw_events(spark, sf_dir)).select("event_id", "user_id", "user_agent")


@query
def route_good(spark, sf_dir):
    return chain.accepted(chain.checked(raw_events(spark, sf_dir))).select(EVENT_SCHEMA.fieldNames())


@query
def route_dlq(spark, sf_dir):
    return chain.rejected(chain.checked(raw_events(spark, sf_dir))).select("event_id", *SOURCE_COLUMNS, "error_reason")


@query
def normalize_events(spark, sf_dir):
    return chain.normalize(raw_events(spark, sf_dir)).select("event_id", "geo_country", "search_query")


@query
def enrich_events(spark, sf_dir):
    return chain.enrich(raw_events(spark, sf_dir)).select("event_id", "revenue_cents", "event_hour", "is_mobile")


@query
def process_events(spark, sf_dir):
    return stored_events(spark, sf_dir)


@query
def dlq_envelope(spark, sf_dir):
    letters = dead(spark, sf_dir).drop("failed_at", "failed_at_iso")
    return letters.withColumn("key", F.concat_ws(":", *SOURCE_COLUMNS))


@query
def dlq_message(spark, sf_dir):
    letters = dead(spark, sf_dir).drop("failed_at", "failed_at_iso")
    return dead_letters.message(letters)


@query
def dlq_by_class(spark, sf_dir):
    return metrics.dead_letters_by_class(dead(spark, sf_dir))


@query
def dlq_replay(spark, sf_dir):
    def repair(events: DataFrame) -> DataFrame:
        return events.withColumns({
            "price_cents": F.abs("price_cents"),
            "quantity": F.greatest("quantity", F.lit(1)),
            "absent_fields": F.array_except("absent_fields", F.array(F.lit("geo_country"))),
        })

    passed = chain.accepted(dead_letters.replay(dead(spark, sf_dir), repair))
    return chain.to_stored(chain.refine(passed))


# --- storing and publishing -------------------------------------------------------------------------

@query
def idempotent_insert(spark, sf_dir):
    """What an insert adds when every event is sent twice and the first half of the month is stored."""
    rows = good_events(spark, sf_dir)
    # Fixed value: 2024-01-16 00:00 UTC in ms.
    stored = rows.where(F.col("timestamp") < 1_705_363_200_000)
    again = rows.withColumn("source_offset", F.col("source_offset") + 1_000_000_000)
    incoming = first_per_key(rows.unionByName(again), ["event_id"], ["source_offset"])
    new = not_stored(incoming, stored, ["event_id"])
    return new.withColumnRenamed("timestamp", "event_timestamp_ms").select(*STORED_COLUMNS, "source_offset")


@query
def table_constraint_check(spark, sf_dir):
    """Constraints of the three tables; the events are checked with every event sent twice."""
    rows = stored_events(spark, sf_dir)
    checks = [
        constraints.constraint_report(rows.unionAll(rows), "clickstream_events"),
        constraints.constraint_report(window_metrics(spark, sf_dir), "aggregated_metrics"),
        constraints.constraint_report(dead(spark, sf_dir), "dead_letter_events"),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query
def keyed_publish(spark, sf_dir):
    return messages.event_messages(raw_events(spark, sf_dir))


@query
def metrics_publish(spark, sf_dir):
    sent = messages.metric_messages(window_metrics(spark, sf_dir))
    def field(name: str, kind: str) -> Column:
        found = F.get_json_object("value", f"$.{name}")
        return (found if kind.startswith("array") else found.cast(kind)).alias(name)

    # All fields but the time of sending.
    return sent.select("key", *[field(f.name, f.dataType.simpleString()) for f in METRICS_SCHEMA.fields])


# --- reports ------------------------------------------------------------------------------------------

@query
def q01_events_over_time(spark, sf_dir):
    now = newest_ms(good_events(spark, sf_dir))
    return flat(reports.events_over_time(stored_events(spark, sf_dir), now))


@query
def q01_events_per_second(spark, sf_dir):
    now = newest_ms(good_events(spark, sf_dir))
    return flat(reports.events_over_time(stored_events(spark, sf_dir), now, clock.DAY_MS, "second"))


@query
def q02_revenue_by_category(spark, sf_dir):
    return reports.revenue_by_category(stored_events(spark, sf_dir), newest_ms(good_events(spark, sf_dir)))


@query
def q03_funnel(spark, sf_dir):
    return reports.funnel(stored_events(spark, sf_dir))


@query
def q04_top_products(spark, sf_dir):
    return reports.top_products(stored_events(spark, sf_dir))


@query
def q05_session_analysis(spark, sf_dir):
    return reports.session_depth(stored_events(spark, sf_dir))


@query
def q06_geo(spark, sf_dir):
    return reports.geography(stored_events(spark, sf_dir))


@query
def q07_mobile_conversion(spark, sf_dir):
    return reports.mobile_conversion(stored_events(spark, sf_dir))


@query
def q08_hourly(spark, sf_dir):
    return reports.hourly(stored_events(spark, sf_dir))


@query
def q09_dlq_inspection(spark, sf_dir):
    """Dead letters by reason; the log has no failure time, so the event time stands for it."""
    rejected = chain.rejected(chain.checked(raw_events(spark, sf_dir)))
    return flat(reports.dead_letter_reasons(rejected.withColumnRenamed("timestamp", "failed_at")))


@query
def q10_window_history(spark, sf_dir):
    return flat(reports.window_history(window_metrics(spark, sf_dir)))


# --- windows and sessions -----------------------------------------------------------------------------

@query
def tumbling_1m(spark, sf_dir):
    return flat(windows.tumbling(good_events(spark, sf_dir), SETTINGS.minute_seconds, PER_MINUTE))


@query
def tumbling_5m(spark, sf_dir):
    return flat(windows.tumbling(good_events(spark, sf_dir), SETTINGS.revenue_seconds, PER_5_MINUTES))


def _ranked(spark, sf_dir, facet: str, k: int) -> DataFrame:
    # Days, so that the ranks have something to rank.
    items = windows.item_counts(good_events(spark, sf_dir), 86_400)
    return windows.rank_items(items.where(F.col("facet") == facet), k).select("window_start", "rank", "key", "n", "first_ms")


@query
def window_top_products(spark, sf_dir):
    return _ranked(spark, sf_dir, windows.PRODUCT, windows.TOP_PRODUCTS)


@query
def window_top_categories(spark, sf_dir):
    return _ranked(spark, sf_dir, windows.CATEGORY, windows.TOP_CATEGORIES)


@query
def all_window_metrics(spark, sf_dir):
    return flat(window_metrics(spark, sf_dir))


@query
def sessions(spark, sf_dir):
    return flat(session_ops.sessions(good_events(spark, sf_dir), SETTINGS.session_gap_seconds))


@query
def sessions_6h(spark, sf_dir):
    return flat(session_ops.sessions(good_events(spark, sf_dir), LONG_GAP.session_gap_seconds))


@query
def open_windows(spark, sf_dir):
    good = good_events(spark, sf_dir)
    return windows.open_windows(good, newest_ms(good), SETTINGS)


@query
def open_sessions(spark, sf_dir):
    good = good_events(spark, sf_dir)
    return session_ops.open_sessions(good, newest_ms(good), LONG_GAP)


def arrivals(good: DataFrame) -> DataFrame:
    """The events with an arrival order in which every 211th comes late."""
    n = F.col("source_offset")
    delayed = F.when(n % 211 == 0, n + ARRIVAL_DELAY).otherwise(n)
    return good.withColumn("source_offset", delayed * 2 + F.when(n % 211 == 0, F.lit(1)).otherwise(F.lit(0)))


@query
def late_event_report(spark, sf_dir):
    found = late.late_events(arrivals(good_events(spark, sf_dir)), SETTINGS.revenue_seconds, SETTINGS.lateness_seconds,
                             block_size=2_000)
    return found.select("event_id", "source_partition", "source_offset", "timestamp", "window_start", "window_end",
                        "newest_ms", "late_by_ms")


@query
def restated_windows(spark, sf_dir):
    """The 5-minute windows that late events belong to, counted again with them."""
    good = good_events(spark, sf_dir)
    found = late.late_events(arrivals(good), SETTINGS.revenue_seconds, SETTINGS.lateness_seconds, block_size=2_000)
    return flat(windows.restate(good, found, SETTINGS.revenue_seconds, PER_5_MINUTES))


# --- metrics ------------------------------------------------------------------------------------------

@query
def metrics_totals(spark, sf_dir):
    return metrics.totals(window_metrics(spark, sf_dir))


@query
def metrics_unique_users(spark, sf_dir):
    return metrics.distinct_users(good_events(spark, sf_dir))


@query
def metrics_history(spark, sf_dir):
    return flat(metrics.history(window_metrics(spark, sf_dir)))


@query
def metrics_latest(spark, sf_dir):
    return flat(metrics.latest(window_metrics(spark, sf_dir)))


@query
def recent_window_log(spark, sf_dir):
    return metrics.activity_log(window_metrics(spark, sf_dir))


@query
def metrics_running_totals(spark, sf_dir):
    return metrics.running_totals(window_metrics(spark, sf_dir))


@query
def throughput_between_windows(spark, sf_dir):
    return metrics.throughput(window_metrics(spark, sf_dir))


@query
def event_type_distribution(spark, sf_dir):
    return metrics.type_distribution(window_metrics(spark, sf_dir))


@query
def category_rank_bars(spark, sf_dir):
    return metrics.category_bars(window_metrics(spark, sf_dir))


@query
def stage_counters(spark, sf_dir):
    checked = chain.checked(decoded(spark, sf_dir))
    return metrics.stage_counters(checked, window_metrics(spark, sf_dir))


# --- streams ------------------------------------------------------------------------------------------

def stream_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.process(activity_log.to_events(activity_log.stream_log(spark, sf_dir)))


def _run(query_) -> None:
    query_.awaitTermination()


@query
def stream_tumbling_1m(spark, sf_dir):
    root = fresh_dir(spark, "stream-1m")
    tables = Tables(spark, root)
    _run(jobs.window_metrics(stream_good(spark, sf_dir), SETTINGS.minute_seconds, PER_MINUTE,
                             jobs.metrics_to_table(tables), f"{root}/state", SETTINGS, once=True))
    return flat(tables.metrics().select(METRICS_COLUMNS))


@query
def stream_tumbling_5m(spark, sf_dir):
    root = fresh_dir(spark, "stream-5m")
    tables = Tables(spark, root)
    _run(jobs.window_metrics(stream_good(spark, sf_dir), SETTINGS.revenue_seconds, PER_5_MINUTES,
                             jobs.metrics_to_table(tables), f"{root}/state", SETTINGS, once=True))
    return flat(tables.metrics().select(METRICS_COLUMNS))


@query
def stream_sessions(spark, sf_dir):
    root = fresh_dir(spark, "stream-sessions")
    tables = Tables(spark, root)
    _run(jobs.session_metrics(stream_good(spark, sf_dir), jobs.metrics_to_table(tables), f"{root}/state", LONG_GAP,
                              once=True))
    return flat(tables.metrics().select(METRICS_COLUMNS))


@query
def stream_rows(spark, sf_dir):
    """Damaged messages through the row stream; both tables, counted by date and reason."""
    root = fresh_dir(spark, "stream-rows")
    tables = Tables(spark, root)
    events = decode.decode_json(activity_log.to_messages(activity_log.stream_log(spark, sf_dir)))
    _run(jobs.store_rows(events, tables, f"{root}/state", SETTINGS, once=True))
    good = tables.events().groupBy(F.col("event_type").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("revenue_cents").alias("revenue_cents"))
    letters = tables.dead_letters().groupBy(F.col("error_reason").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("revenue_cents"))
    return good.select(F.lit("events").alias("table_name"), "*").unionByName(
        letters.select(F.lit("dead_letters").alias("table_name"), "*"))


def message_files(spark: SparkSession, sf_dir: str, path: str, parts: int, in_time: bool = True) -> int:
    """The damaged messages in `parts` parts of as many files each, one part after another by position; how many files. With
    `in_time` False every 211th comes late."""
    log = activity_log.read_log(spark, sf_dir)
    n = F.col("event_id")
    arrival = n if in_time else F.when(n % 211 == 0, n + ARRIVAL_DELAY).otherwise(n)
    last = log.agg(F.max("event_id")).first()[0]
    files = message_file_count(last, parts)
    for part in range(parts):
        low, high = part * (last + 1) // parts, (part + 1) * (last + 1) // parts
        found = log.where(arrival >= low)
        write_messages(found if part == parts - 1 else found.where(arrival < high), path, files)
    return files


def message_file_count(last: int | None, parts: int) -> int:
    return 2 + (last or 0) // parts // MESSAGES_PER_FILE


def write_messages(log: DataFrame, path: str, files: int) -> None:
    """Damaged messages of log rows in so many files. The rows are spread before they are encoded: they are narrower than their
    messages, and the few row groups of a log do not bound the tasks."""
    activity_log.to_messages(log.repartition(files)).write.mode("append").parquet(path)


def micro_batches(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """Histogram of the sizes of the micro-batches in which a row stream read the messages."""
    root = fresh_dir(spark, "micro-batches")
    files = message_files(spark, sf_dir, f"{root}/messages", parts)
    events = decode.decode_json(topics.stream_files(spark, f"{root}/messages", files))
    rows = jobs.store_rows(events, Tables(spark, f"{root}/tables"), f"{root}/state", SETTINGS, once=True)
    _run(rows)
    progress = ProgressLog(spark, f"{root}/progress")
    progress.complete(rows)
    progress.flush()
    return metrics.micro_batch_sizes(progress.read())


@query
def batch_size_histogram(spark, sf_dir):
    return micro_batches(spark, sf_dir, 3)


@query
def batch_size_histogram_small_batches(spark, sf_dir):
    """More and smaller micro-batches of the same messages."""
    return micro_batches(spark, sf_dir, 8)


@query
def load_then_stream(spark, sf_dir):
    """The messages loaded, streamed again in three micro-batches and their dead letters replayed: every row once."""
    root = fresh_dir(spark, "load-then-stream")
    tables, messages_ = Tables(spark, f"{root}/tables"), f"{root}/messages"
    files = message_files(spark, sf_dir, messages_, 3)
    batch.load(spark, tables, SETTINGS, messages_)
    events = decode.decode_json(topics.stream_files(spark, messages_, files))
    _run(jobs.store_rows(events, tables, f"{root}/state", SETTINGS, once=True))
    batch.replay(tables, SETTINGS)
    letters = tables.dead_letters().select(F.lit("dead_letters").alias("table_name"), F.concat_ws(":", *SOURCE_COLUMNS).alias("row_key"),
                                           F.col("error_reason").alias("label"))
    return letters.unionByName(tables.events().select(
        F.lit("events").alias("table_name"), F.col("event_id").alias("row_key"), F.col("event_type").alias("label")))


@query
def loaded_metrics(spark, sf_dir):
    """The aggregates after three loads, each of which computes again only what its rows touch."""
    root = fresh_dir(spark, "loads")
    tables = Tables(spark, f"{root}/tables")
    log = activity_log.read_log(spark, sf_dir)
    files = message_file_count(log.agg(F.max("event_id")).first()[0], 3)
    for part in range(3):
        write_messages(log.where(F.col("event_id") % 3 == part), f"{root}/messages-{part}", files)
        batch.load(spark, tables, SETTINGS, f"{root}/messages-{part}")
    return flat(tables.metrics().select(METRICS_COLUMNS))


@query
def unplaced_dead_letters(spark, sf_dir):
    """Rejected messages that came from no topic, stored twice over: none is lost."""
    tables = Tables(spark, fresh_dir(spark, "unplaced"))
    letters = dead(spark, sf_dir).withColumns({c: F.lit(None).cast(k) for c, k in dead(spark, sf_dir).select(*SOURCE_COLUMNS).dtypes})
    for _ in range(2):
        tables.insert(letters, DEAD_LETTERS)
    return tables.dead_letters().select("original_payload", "error_reason", *SOURCE_COLUMNS)


@query
def stream_then_restate(spark, sf_dir):
    """Messages in five micro-batches, some of them late, and what was too late repaired: the closed windows and sessions."""
    root = fresh_dir(spark, "restate")
    tables, messages_ = Tables(spark, f"{root}/tables"), f"{root}/messages"
    files = message_files(spark, sf_dir, messages_, 5, in_time=False)
    events = decode.decode_json(topics.stream_files(spark, messages_, files))
    started = [jobs.store_rows(events, tables, f"{root}/state", SETTINGS, once=True),
               *jobs.all_metrics(chain.process(events), jobs.metrics_to_table(tables), f"{root}/state", SETTINGS, once=True,
                                 note=jobs.marks_to_table(tables))]
    for query_ in started:
        _run(query_)
    batch.restate_late(tables, SETTINGS)
    return flat(tables.metrics().select(METRICS_COLUMNS))


def sketched(spark: SparkSession, sf_dir: str) -> tuple[Tables, DataFrame]:
    """Two thirds of the events inserted and then all, the sketches of their windows brought up to date after each."""
    tables = Tables(spark, fresh_dir(spark, "sketches"), id_buckets=1)
    kept = sketches.Sketches(tables)
    good = good_events(spark, sf_dir).withColumnRenamed("timestamp", "event_timestamp_ms")
    for part in (good.where(F.col("source_offset") % 3 != 0), good):
        tables.insert(part, EVENTS)
        kept.refresh()
    return tables, kept.read()


@query
def users_by_day(spark, sf_dir):
    """Distinct users per day, exact and, from the sketches of minutes, within the bound of the estimate."""
    tables, found = sketched(spark, sf_dir)
    day = clock.floor_to(F.col("event_timestamp_ms"), clock.DAY_MS).alias("window_start")
    exact = tables.events().groupBy(day).agg(F.count_distinct("user_id").alias("unique_users"))
    near = F.abs(F.col("estimated_users") - F.col("unique_users")) <= F.col("error_bound")
    return exact.join(sketches.users_by_span(found), "window_start", "full").select(
        "window_start", "event_count", "unique_users", near.alias("within_bound"))


@query
def top_products_by_day(spark, sf_dir):
    """The ten most frequent products of each day, from the sketches of minutes."""
    return sketches.top_products_by_span(sketched(spark, sf_dir)[1])


@query
def stream_updates(spark, sf_dir):
    """5-minute windows kept up to date while a stream runs: open ones and those that late messages change are there as well."""
    root = fresh_dir(spark, "updates")
    files = message_files(spark, sf_dir, f"{root}/messages", 3, in_time=False)
    good = chain.process(decode.decode_json(topics.stream_files(spark, f"{root}/messages", files)))
    live = updates.LiveWindows(spark, f"{root}/live")
    # The log spans a month, and a message may be late by nearly all of it.
    _run(updates.update_windows(good, SETTINGS.revenue_seconds, live, f"{root}/state", SETTINGS, once=True, correct_seconds=31 * 86_400))
    return live.read().select("window_start", *ADDITIVE, F.hll_sketch_estimate("users").alias("unique_users"))


@query
def stream_dedupe(spark, sf_dir):
    """Every event sent twice, stored once."""
    root = fresh_dir(spark, "stream-dedupe")
    tables = Tables(spark, root)
    log = activity_log.stream_log(spark, sf_dir)
    twice = activity_log.to_events(log).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    _run(jobs.store_distinct(chain.process(twice), tables, f"{root}/state", SETTINGS, once=True))
    return tables.events().select(STORED_COLUMNS)
