"""Tumbling windows and sessions on tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import T0

from clickloom.config import Settings
from clickloom.operators import chain, late, sessions, windows
from clickloom.plans import metrics
from clickloom.schemas import PER_5_MINUTES, PER_MINUTE, SESSION

S = Settings()


def purchase(price: int, **more) -> dict:
    return {"event_type": "purchase", "price_cents": price, "quantity": 1, **more}


def minute(make, *rows, seconds=60, kind=PER_MINUTE):
    return windows.tumbling(chain.process(make(*rows)), seconds, kind).orderBy("window_start").collect()


def test_same_window(make):
    found = minute(make, *[{"timestamp": T0 + i * 4_500, "user_id": f"u{i % 4}"} for i in range(7)])
    assert [(r.event_count, r.unique_users, r.window_type) for r in found] == [(7, 4, PER_MINUTE)]
    assert found[0].window_start == T0 // 60_000 * 60_000 and found[0].window_end == found[0].window_start + 60_000


def test_two_windows_and_exclusive_end(make):
    assert len(minute(make, {"timestamp": T0 - 40_000}, {"timestamp": T0}, {"timestamp": T0 + 150_000})) == 3
    start = T0 // 60_000 * 60_000
    found = minute(make, {"timestamp": start}, {"timestamp": start + 59_999}, {"timestamp": start + 60_000})
    assert [r.event_count for r in found] == [2, 1]


def test_revenue_and_types(make):
    found = minute(make, purchase(310), purchase(45), purchase(620, quantity=2), purchase(7), seconds=300, kind=PER_5_MINUTES)
    assert [(r.total_revenue_cents, r.purchases) for r in found] == [(1602, 4)]
    found = minute(make, {}, {"event_type": "add_to_cart"}, purchase(45), {"event_type": "wishlist"}, {"event_type": "add_to_cart"})
    assert [(r.page_views, r.add_to_carts, r.purchases, r.event_count) for r in found] == [(1, 2, 1, 5)]


def test_unique_users(make):
    assert minute(make, *[{"user_id": u} for u in ("kim", "lee", "kim", "max", "lee", "kim")])[0].unique_users == 3


def test_top_lists(make):
    found = minute(make, {"product_id": "hose"}, *[{"product_id": "spade"}] * 3, *[{"product_id": "seeds"}] * 2)
    assert found[0].top_products == ["spade", "seeds", "hose"]
    assert found[0].top_categories == ["Garden"]
    # Ties go to the key that was seen first; blank and null keys are left out.
    found = minute(make, {"product_id": "b", "timestamp": T0 + 5}, {"product_id": "a", "timestamp": T0 + 9},
                   {"product_id": "c", "timestamp": T0 + 5}, {"product_id": ""}, {"product_id": None})
    assert found[0].top_products == ["b", "c", "a"]
    found = minute(make, *[{"product_id": f"p{i:02}", "product_category": f"c{i:02}", "timestamp": T0 + i} for i in range(12)])
    assert found[0].top_products == [f"p{i:02}" for i in range(10)]
    assert found[0].top_categories == [f"c{i:02}" for i in range(5)]


def test_window_without_items(make):
    found = minute(make, {"product_id": None, "product_category": None})
    assert found[0].top_products == [] and found[0].top_categories == []


def test_closing(make):
    good = chain.process(make({"timestamp": T0}))
    table = windows.tumbling(good, 60, PER_MINUTE)
    end = T0 // 60_000 * 60_000 + 60_000
    assert windows.closed(table, end + 29_999, 30).count() == 0
    assert windows.closed(table, end + 30_000, 30).count() == 1
    assert {r.window_type: r.open_windows for r in windows.open_windows(good, end + 29_999, S).collect()} == {
        PER_MINUTE: 1, PER_5_MINUTES: 1}
    assert {r.window_type: r.open_windows for r in windows.open_windows(good, end + 30_000, S).collect()} == {
        PER_MINUTE: 0, PER_5_MINUTES: 1}


def test_long_windows_from_short_ones(make):
    rng = random.Random(5)
    rows = [{"timestamp": T0 + rng.randrange(3_600_000), "user_id": f"u{rng.randrange(9)}", "product_id": f"p{rng.randrange(30)}",
             "product_category": f"c{rng.randrange(8)}"} for _ in range(800)]
    good = chain.process(make(*rows))
    both = windows.minute_and_revenue_windows(good, S)
    apart = windows.tumbling(good, 60, PER_MINUTE).unionByName(windows.tumbling(good, 300, PER_5_MINUTES))
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    odd = Settings(revenue_seconds=90)
    both = windows.minute_and_revenue_windows(good, odd)
    apart = windows.tumbling(good, 60, PER_MINUTE).unionByName(windows.tumbling(good, 90, PER_5_MINUTES))
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))


# --- sessions -----------------------------------------------------------------------------------------

def found_sessions(make, *rows, gap=1800):
    return sessions.sessions(chain.process(make(*rows)), gap).orderBy("user_id", "window_start").collect()


def test_one_session(make):
    found = found_sessions(make, *[{"timestamp": T0 + i * 700_000} for i in range(4)])
    assert [(r.event_count, r.window_start, r.window_end, r.window_type, r.unique_users, r.top_products) for r in found] == [
        (4, T0, T0 + 2_100_000, SESSION, 1, [])]


def test_users_have_sessions_of_their_own(make):
    assert [r.event_count for r in found_sessions(make, *[{"user_id": u} for u in ("lee", "kim", "lee", "max", "lee")])] == [1, 3, 1]


def test_session_ids_of_one_user(make):
    assert len(found_sessions(make, {"session_id": "a"}, {"session_id": "b"})) == 2


def test_gap_splits_only_when_exceeded(make):
    assert len(found_sessions(make, {"timestamp": T0}, {"timestamp": T0 + 1_800_000})) == 1
    assert len(found_sessions(make, {"timestamp": T0}, {"timestamp": T0 + 1_800_001})) == 2


def test_session_order_of_arrival_does_not_matter(make):
    rows = [{"timestamp": T0 + i * 1_000_000} for i in (4, 0, 2, 1, 3)]
    assert [(r.window_start, r.window_end) for r in found_sessions(make, *rows)] == [(T0, T0 + 4_000_000)]


def test_session_revenue(make):
    assert found_sessions(make, purchase(1000), purchase(2000), purchase(3000))[0].total_revenue_cents == 6000


def test_open_sessions(make):
    good = chain.process(make({"user_id": "A"}, {"user_id": "B", "timestamp": T0 + 1_000_000},
                              {"user_id": "B", "timestamp": T0}))
    for now, still_open in [(T0 + 1_000_000, 2), (T0 + 1_829_999, 2), (T0 + 1_830_000, 1), (T0 + 2_830_000, 0)]:
        assert sessions.open_sessions(good, now, S).first()[0] == still_open


@pytest.mark.parametrize("seed", range(3))
def test_sessions_against_plain_loop(make, seed):
    rng = random.Random(seed)
    # One key holds a third of the rows.
    rows = [{"user_id": "hot" if rng.random() < 0.34 else f"u{rng.randrange(6)}", "session_id": "s",
             "timestamp": T0 + rng.randrange(200_000)} for _ in range(400)]
    gap, times = 2, defaultdict(list)
    for r in rows:
        times[r["user_id"]].append(r["timestamp"])
    expected = []
    for user, ts in times.items():
        run = []
        for t in sorted(ts):
            if run and t - run[-1] > gap * 1000:
                expected.append((user, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        expected.append((user, run[0], run[-1], len(run)))
    found = [(r.user_id, r.window_start, r.window_end, r.event_count) for r in found_sessions(make, *rows, gap=gap)]
    assert sorted(found) == sorted(expected)


# --- late events --------------------------------------------------------------------------------------

@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_late_events_against_plain_loop(make, block):
    rng = random.Random(block)
    rows = [{"timestamp": T0 + i * 9_000 - (rng.random() < 0.1) * rng.randrange(200_000), "source_partition": i % 3}
            for i in range(300)]
    good = chain.process(make(*rows))
    found = {r.event_id: r.newest_ms for r in late.late_events(good, 60, 30, block_size=block).collect()}
    newest, expected = defaultdict(lambda: None), {}
    for i, r in enumerate(rows):
        seen, t = newest[r["source_partition"]], r["timestamp"]
        if seen is not None and t // 60_000 * 60_000 + 90_000 <= seen:
            expected[f"e{i}"] = seen
        newest[r["source_partition"]] = t if seen is None else max(seen, t)
    assert found == expected and expected


def test_restated_windows(make):
    rows = [{"timestamp": T0 + i * 10_000} for i in range(100)]
    good = chain.process(make(*rows))
    late_rows = chain.process(make({"timestamp": T0 + 400_000}))
    found = windows.restate(good, late_rows, 60, PER_MINUTE).collect()
    full = windows.tumbling(good, 60, PER_MINUTE).where(f"window_start = {(T0 + 400_000) // 60_000 * 60_000}").collect()
    assert found == full and len(found) == 1


# --- metrics ------------------------------------------------------------------------------------------

def test_running_totals_and_throughput_cross_blocks(make):
    rows = [{"timestamp": T0 + i * 1_500_000, "user_id": f"u{i}"} for i in range(12)]
    table = windows.tumbling(chain.process(make(*rows)), 60, PER_MINUTE)
    totals = metrics.running_totals(table).orderBy("window_start").collect()
    assert [r.total_events for r in totals] == list(range(1, 13))
    pace = metrics.throughput(table).orderBy("window_end").collect()
    assert pace[0].events_per_second == 0.0 and pace[0].elapsed_seconds is None
    assert [r.elapsed_seconds for r in pace[1:]] == [1500.0] * 11


def test_batch_sizes(spark):
    batches = spark.createDataFrame([(500, 2), (203, 1), (1, 1)], "batch_size long, batches long")
    lines = {r.le: r.batches for r in metrics.batch_size_histogram(batches).collect()}
    assert lines == {"10": 1, "50": 1, "100": 1, "250": 2, "500": 4, "1000": 4, "+Inf": 4}
