"""Streams: closed windows and sessions equal the batch results, late rows, repeats, restarts."""

from __future__ import annotations

import random
import time

import pytest
from conftest import T0
from pyspark.sql import functions as F

from clickloom.config import Settings
from clickloom.operators import chain, windows
from clickloom.plans import metrics
from clickloom.schemas import METRICS_COLUMNS, PER_5_MINUTES, PER_MINUTE, RAW_SCHEMA, SESSION
from clickloom.sinks.tables import Tables
from clickloom.operators.dead_letters import event_json
from clickloom.sources.decode import decode_json
from clickloom.sources.topics import stream_files
from clickloom.streaming import jobs, updates
from clickloom.streaming.progress import ProgressLog

S = Settings(session_gap_seconds=120)


class Feed:
    """A folder of message files, one file per call."""

    def __init__(self, spark, make, path):
        self.spark, self.make, self.path = spark, make, str(path)
        self.sent = 0

    def send(self, *rows: dict, raw: list[bytes] = ()):
        numbered = [{"event_id": f"e{self.sent + i}", "source_offset": self.sent + i, **r} for i, r in enumerate(rows)]
        df = self.make(*numbered, partitions=1).select(
            F.encode(event_json(), "UTF-8").alias("value"), "source_topic", "source_partition", "source_offset")
        self.sent += len(rows)
        if raw:
            more = [(bytearray(v), "clickstream.events", 0, self.sent + i) for i, v in enumerate(raw)]
            self.sent += len(raw)
            df = df.unionByName(self.spark.createDataFrame(more, RAW_SCHEMA))
        df.coalesce(1).write.mode("append").parquet(self.path)

    def events(self):
        return decode_json(stream_files(self.spark, self.path, files_per_trigger=1))

    def table(self):
        return decode_json(self.spark.read.schema(RAW_SCHEMA).parquet(self.path))


@pytest.fixture
def feed(spark, make, tmp_path):
    return Feed(spark, make, tmp_path / "feed")


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "store"))


def finish(*queries):
    for q in queries:
        assert q.awaitTermination(120)
        assert q.exception() is None


def as_set(df):
    return sorted(map(str, df.select(METRICS_COLUMNS).collect()))


def random_rows(seed: int, n: int, start: int):
    rng = random.Random(seed)
    return [{"timestamp": start + i * 1_500 + rng.randrange(1_000), "user_id": f"u{seed}{rng.randrange(5)}", "session_id": "s",
             "event_type": rng.choice(["page_view", "add_to_cart", "purchase", "INVALID"]),
             "product_id": rng.choice(["p1", "p2", "p3", None]), "product_category": rng.choice(["c1", "c2", ""]),
             "quantity": 1 + rng.randrange(3)} for i in range(n)]


def test_streams_equal_batch(feed, tables, tmp_path):
    for part in range(3):
        feed.send(*random_rows(part, 150, T0 + part * 225_000))
    good = chain.process(feed.events())
    finish(*jobs.all_metrics(good, jobs.metrics_to_table(tables), str(tmp_path / "state"), S, once=True))
    batch = chain.process(feed.table())
    newest = batch.agg(F.max("timestamp")).first()[0]
    all_metrics = metrics.all_window_metrics(batch, S)
    expected = windows.closed(all_metrics.where(F.col("window_type") != SESSION), newest, 30).unionByName(
        windows.closed(all_metrics.where(F.col("window_type") == SESSION), newest, 30, S.session_gap_seconds))
    found = tables.metrics()
    assert as_set(found) == as_set(expected)
    kinds = {r.window_type for r in found.select("window_type").distinct().collect()}
    assert kinds == {PER_MINUTE, PER_5_MINUTES, SESSION}


def test_rows_are_stored_once_and_rejected_rows_kept(feed, tables, tmp_path, spark):
    settings = Settings()
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        feed.send({}, {"timestamp": 0}, {"user_agent": "Googlebot"}, raw=[b"\xff", b"{"])
        feed.send({"event_id": "e0", "quantity": 7}, {"event_id": "new"}, {"event_id": "new"})
        finish(jobs.store_rows(feed.events(), tables, str(tmp_path / "state"), settings, once=True))
        # A restart goes on after the last offset.
        feed.send({"event_id": "e0"}, {"event_id": "third"})
        finish(jobs.store_rows(feed.events(), tables, str(tmp_path / "state"), settings, once=True))
        # Progress arrives some time after the batch.
        until = time.time() + 20
        while len([r for r in log._rows if r[3]]) < 3 and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert sorted((r.event_id, r.quantity) for r in tables.events().collect()) == [("e0", 1), ("new", 1), ("third", 1)]
    reasons = sorted(r.error_reason for r in tables.dead_letters().collect())
    assert reasons == ["Deserialization error: value does not match the event schema",
                       "Deserialization error: value is not UTF-8 text", "Filtered as bot traffic", "Invalid timestamp: 0"]
    log.flush()
    seen = log.read().where("input_rows > 0").agg(F.sum("accepted"), F.sum("rejected")).first()
    assert tuple(seen) == (6, 4)


def test_late_rows(feed, tables, tmp_path):
    minute = T0 // 60_000 * 60_000
    feed.send({"timestamp": minute + 1_000})
    # Moves the watermark to 29 s after the window's end: still open.
    feed.send({"timestamp": minute + 89_000})
    feed.send({"timestamp": minute + 2_000})
    # Closes the window; a row in a later file comes too late.
    feed.send({"timestamp": minute + 200_000})
    feed.send({"timestamp": minute + 210_000})
    feed.send({"timestamp": minute + 3_000})
    good = chain.process(feed.events())
    finish(jobs.window_metrics(good, 60, PER_MINUTE, jobs.metrics_to_table(tables), str(tmp_path / "state"), S, once=True))
    counts = {r.window_start - minute: r.event_count for r in tables.metrics().collect()}
    assert counts == {0: 2, 60_000: 1}
    # Counting the window again from all rows restores it.
    late_rows = chain.process(feed.table()).where(F.col("timestamp") == minute + 3_000)
    tables.upsert_metrics(windows.restate(chain.process(feed.table()), late_rows, 60, PER_MINUTE))
    counts = {r.window_start - minute: r.event_count for r in tables.metrics().collect()}
    assert counts == {0: 3, 60_000: 1}


def test_broken_times_do_not_move_the_watermark(feed, tables, tmp_path):
    minute = T0 // 60_000 * 60_000
    feed.send({"timestamp": minute})
    feed.send({"timestamp": 253_402_300_800_000}, {"timestamp": minute + 500_000, "event_type": "INVALID"})
    feed.send({"timestamp": minute + 1})
    good = chain.process(feed.events())
    finish(jobs.window_metrics(good, 60, PER_MINUTE, jobs.metrics_to_table(tables), str(tmp_path / "state"), S, once=True))
    assert tables.metrics().count() == 0


def test_windows_go_on_after_a_restart(feed, tables, tmp_path):
    def run():
        finish(jobs.window_metrics(chain.process(feed.events()), 60, PER_MINUTE, jobs.metrics_to_table(tables),
                                   str(tmp_path / "state"), S, once=True))

    minute = T0 // 60_000 * 60_000
    feed.send({"timestamp": minute, "user_id": "A"})
    run()
    feed.send({"timestamp": minute + 1, "user_id": "B"}, {"timestamp": minute + 300_000})
    run()
    assert [(r.event_count, r.unique_users) for r in tables.metrics().collect()] == [(2, 2)]


def test_session_closes_after_gap_and_lateness(feed, tables, tmp_path):
    feed.send({"timestamp": T0}, {"timestamp": T0 + 120_000})
    feed.send({"timestamp": T0 + 240_001, "user_id": "B"})
    feed.send({"timestamp": T0 + 270_000, "user_id": "B"})
    good = chain.process(feed.events())
    finish(jobs.session_metrics(good, jobs.metrics_to_table(tables), str(tmp_path / "state"), S, once=True))
    assert [(r.window_start, r.window_end, r.event_count) for r in tables.metrics().collect()] == [(T0, T0 + 120_000, 2)]


def test_repeats_are_dropped(feed, tables, tmp_path):
    feed.send({"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"})
    feed.send({"event_id": "a"}, {"event_id": "c"})
    good = chain.process(feed.events())
    finish(jobs.store_distinct(good, tables, str(tmp_path / "state"), S, once=True))
    assert sorted(r.event_id for r in tables.events().collect()) == ["a", "b", "c"]


def test_an_id_on_another_day_is_a_repeat(feed, tables, tmp_path):
    feed.send({"event_id": "a"})
    feed.send({"event_id": "a", "timestamp": T0 + 3 * 86_400_000})
    finish(jobs.store_rows(feed.events(), tables, str(tmp_path / "state"), Settings(), once=True))
    assert [r.event_timestamp_ms for r in tables.events().collect()] == [T0]


def test_a_batch_that_runs_again_changes_nothing(feed, tables, tmp_path):
    """The write of a batch succeeded, its commit did not."""
    feed.send({"event_id": "a"}, {"timestamp": 0})
    state = tmp_path / "state"
    finish(jobs.store_rows(feed.events(), tables, str(state), Settings(), once=True))
    commits = sorted((state / "rows" / "commits").glob("[0-9]*"))
    for path in [*commits, *(state / "rows" / "commits").glob(".*crc")]:
        path.unlink()
    finish(jobs.store_rows(feed.events(), tables, str(state), Settings(), once=True))
    assert tables.events().count() == 1 and tables.dead_letters().count() == 1


def test_rejected_rows_of_no_topic_are_all_kept(feed, tables, tmp_path):
    feed.send(*[{"timestamp": 0}] * 4, {"event_id": "a"})
    feed.send(*[{"timestamp": 0}] * 3)
    events = feed.events().withColumns({"source_topic": F.lit(None).cast("string"), "source_partition": F.lit(None).cast("int"),
                                        "source_offset": F.lit(None).cast("long")})
    finish(jobs.store_rows(events, tables, str(tmp_path / "state"), Settings(), once=True))
    assert tables.dead_letters().count() == 7 and tables.events().count() == 1


def test_a_stateful_micro_batch_runs_at_full_width(feed, spark, tmp_path):
    """As many tasks as state partitions fill the batch, in every micro-batch, although few files are written."""
    tables = Tables(spark, str(tmp_path / "store"), files_per_batch=1)
    for part in range(2):
        feed.send(*random_rows(part, 60, T0 + part * 400_000))
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        widths = []

        def write(found, kind):
            widths.append(found.sparkSession.sparkContext.getLocalProperty("spark.jobGroup.id") or "")
            tables.insert(found.select(METRICS_COLUMNS), "aggregated_metrics", kind, distinct=True, small=True)

        query = jobs.session_metrics(chain.process(feed.events()), write, str(tmp_path / "state"), S, once=True)
        finish(query)
        tracker = spark.sparkContext.statusTracker()
        state_stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(j).stageIds]
        tasks = [s.numTasks for s in state_stages if s is not None]
        assert len(widths) >= 2 and tasks.count(6) >= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_an_insert_of_sessions_does_not_run_the_stateful_plan_again(feed, tables, tmp_path):
    for part in range(2):
        feed.send(*random_rows(part, 60, T0 + part * 400_000))
    plans = []

    def write(found, kind):
        new = tables.new_rows(found.select(METRICS_COLUMNS), "aggregated_metrics", kind, distinct=True, small=True)
        plans.append(new._jdf.queryExecution().withCachedData().toString())
        jobs.metrics_to_table(tables)(found, kind)

    finish(jobs.session_metrics(chain.process(feed.events()), write, str(tmp_path / "state"), S, once=True))
    assert len(plans) >= 2 and "InMemoryRelation" in plans[-1] and "LogicalRDD [user_id" not in plans[-1]
    assert as_set(tables.metrics()) and tables.metrics().count() == tables.metrics().select("window_id").distinct().count()


def test_marks_of_a_micro_batch_are_written_into_few_files(feed, spark, tmp_path):
    """No file per state partition and date."""
    tables = Tables(spark, str(tmp_path / "store"), files_per_batch=1)
    for part in range(2):
        feed.send(*[{**r, "session_id": f"s{i % 9}", "timestamp": r["timestamp"] + i % 3 * 86_400_000 + part * 10 * 86_400_000}
                    for i, r in enumerate(random_rows(part, 90, T0))])
    batches = []
    note = jobs.marks_to_table(tables)
    queries = jobs.all_metrics(chain.process(feed.events()), lambda *_: None, str(tmp_path / "state"), S, once=True,
                               note=lambda found, kind: (batches.append(kind), note(found, kind)))
    finish(*queries)
    for kind in (PER_MINUTE, PER_5_MINUTES, SESSION):
        rows = tables.marks.counted(kind)
        dates = rows.select("event_date").distinct().count()
        assert dates >= 3 and len(rows.inputFiles()) <= batches.count(kind) * dates
        assert rows.groupBy("event_date", F.input_file_name()).count().groupBy("event_date").count().agg(F.max("count")).first()[0] <= batches.count(kind)


def test_open_and_late_windows_are_updated(feed, spark, tmp_path):
    minute = T0 // 60_000 * 60_000
    live = updates.LiveWindows(spark, str(tmp_path / "live"))

    def run():
        finish(updates.update_windows(chain.process(feed.events()), 60, live, str(tmp_path / "state"), S, once=True, correct_seconds=600))
        found = live.read().select("window_start", "event_count", F.hll_sketch_estimate("users").alias("users")).collect()
        return {r.window_start - minute: (r.event_count, r.users) for r in found}

    assert live.read().count() == 0
    feed.send({"timestamp": minute, "user_id": "a"}, {"timestamp": minute + 5, "user_id": "a"}, {"timestamp": minute + 400_000})
    # The newest window is open, and there.
    assert run() == {0: (2, 1), 360_000: (1, 1)}
    # Late, but windows may be corrected for ten minutes; the other window is left as it was.
    feed.send({"timestamp": minute + 9, "user_id": "b"}, {"timestamp": 0})
    assert run() == {0: (3, 2), 360_000: (1, 1)}
    before = sorted(map(str, live.read().collect()))
    assert run() == {0: (3, 2), 360_000: (1, 1)}
    # A micro-batch that runs again changes nothing.
    live.upsert(live.read().where(F.col("event_count") == 3).checkpoint())
    assert sorted(map(str, live.read().collect())) == before
    # Beyond that time a row changes nothing any more.
    feed.send({"timestamp": minute + 2_000_000})
    run()
    feed.send({"timestamp": minute + 10, "user_id": "c"})
    assert run()[0] == (3, 2)
