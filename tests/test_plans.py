"""Physical plans: what is read, what is pushed down, what is never used."""

from __future__ import annotations

import re

import pytest

from clickloom.catalog.queries import QUERIES, stored_events
from clickloom.config import Settings
from clickloom.operators import chain, dedupe, late, sessions, windows
from clickloom.plans import metrics, reports
from clickloom.schemas import PER_MINUTE

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "events")
    stored_events(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ["CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"]:
        assert word not in plan


def test_valid_row_conditions_reach_the_scan(spark, make, tmp_path):
    make({}, {"event_type": "INVALID"}).write.parquet(str(tmp_path / "raw"))
    plan = plan_of(chain.process(spark.read.parquet(str(tmp_path / "raw"))))
    pushed = plan[plan.index("PushedFilters: "):plan.index("ReadSchema")]
    assert "GreaterThan(timestamp,0)" in pushed and "IsNotNull(user_id)" in pushed and "In(event_type, " in pushed


def test_reports_read_only_their_columns(stored):
    def read(df):
        return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().toString()).group(1)))

    assert read(reports.funnel(stored)) == {"event_type"}
    assert read(reports.hourly(stored)) == {"event_hour", "user_id", "revenue_cents"}
    assert read(reports.top_products(stored)) == {"product_id", "product_category", "event_type", "revenue_cents"}


def test_top_reports_keep_k_rows_per_task(stored):
    for report in [reports.top_products, reports.session_depth, reports.geography]:
        assert "TakeOrderedAndProject" in plan_of(report(stored))


def test_ranks_are_cut_before_the_shuffle(stored):
    plan = plan_of(windows.tumbling(chain.from_stored(stored), 60, PER_MINUTE))
    limits = re.findall(r"WindowGroupLimit .*row_number\(\), 10, (\w+)", plan)
    assert sorted(limits) == ["Final", "Partial"]


def test_copies_are_cut_before_the_shuffle(stored):
    plan = plan_of(dedupe.first_per_key(stored, ["event_id"], ["event_timestamp_ms"]))
    assert re.findall(r"WindowGroupLimit .*row_number\(\), 1, (\w+)", plan) == ["Final", "Partial"]


def test_events_are_combined_before_every_shuffle(stored):
    """Below each exchange of events there is a partial aggregate or a cut, never bare events."""
    events = chain.from_stored(stored)
    for df in [windows.tumbling(events, 60, PER_MINUTE), sessions.sessions(events, 1800),
               metrics.all_window_metrics(events, Settings()), reports.session_depth(stored), reports.geography(stored)]:
        lines = plan_of(df).splitlines()
        for n, line in enumerate(lines):
            if re.search(r"Exchange hashpartitioning", line):
                below = re.sub(r"^[\s:+\-|*()\d]*", "", lines[n + 1])
                assert re.match(r"(HashAggregate|ObjectHashAggregate|SortAggregate|WindowGroupLimit)", below), below


def test_late_events_are_sorted_in_blocks(stored):
    events = chain.from_stored(stored).selectExpr("*", "cast(event_hour % 6 AS int) AS source_partition", "cast(event_id AS bigint) AS source_offset")
    plan = plan_of(late.late_events(events, 60, 30))
    assert re.search(r"windowspecdefinition\(_source#\w+, _block", plan)


def executed_plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df)


def test_shared_work_is_done_once(stored):
    events = chain.from_stored(stored)
    both = executed_plan_of(windows.minute_and_revenue_windows(events, Settings()))
    assert both.partition("== Initial Plan ==")[0].count("ReusedExchange") >= 2
    for query in [metrics.running_totals, metrics.throughput]:
        plan = executed_plan_of(query(sessions.session_metrics(events, 1800)))
        assert "ReusedExchange" in plan.partition("== Initial Plan ==")[0]


def test_streams_combine_rows_before_the_shuffle(spark, tmp_path):
    from clickloom.catalog.queries import stream_good
    from clickloom.session import prepare_streaming
    from clickloom.streaming import state

    prepare_streaming(spark)
    good = stream_good(spark, SF_DIR)
    for df, combined in [(state.facet_counts(good, 60, 30), "HashAggregate"),
                         (state.closed_sessions(good, 1800, 30), "MergingSessions")]:
        query = (df.writeStream.format("noop").option("checkpointLocation", str(tmp_path / combined))
                 .trigger(availableNow=True).start())
        query.awaitTermination(120)
        lines = [re.sub(r"^[\s:+\-|*()\d]*", "", line) for line in query._jsq.explainInternal(False).splitlines()]
        shuffle = next(n for n, line in enumerate(lines) if line.startswith("Exchange"))
        assert lines[shuffle + 1].startswith(combined)
