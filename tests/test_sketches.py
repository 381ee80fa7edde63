"""Sketches of users and products: united over spans, brought up to date without counting what has not changed."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from conftest import T0

from clickloom import jobs
from clickloom.functions.clock import DAY_MS
from clickloom.operators import chain
from clickloom.sinks.sketches import Sketches, per_window, top_products_by_span, united, users_by_span
from clickloom.sinks.tables import EVENTS, Tables

MINUTE = 60_000
DAY = T0 - T0 % DAY_MS


def stored(df):
    return chain.process(df).withColumnRenamed("timestamp", "event_timestamp_ms")


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "store"))


def test_no_events(tables):
    kept = Sketches(tables)
    kept.refresh()
    assert kept.read().count() == users_by_span(kept.read()).count() == top_products_by_span(kept.read()).count() == 0


def test_a_user_of_many_minutes_counts_once(make):
    rows = [{"timestamp": T0 + n * MINUTE, "user_id": f"u{n % 7}"} for n in range(60)]
    found = per_window(stored(make(*rows)))
    assert found.count() == 60
    assert [tuple(r) for r in users_by_span(found).collect()] == [(DAY, 60, 7, 1)]


def test_estimates_of_many_users_keep_the_bound(make, spark):
    one = stored(make({})).drop("user_id", "event_timestamp_ms")
    many = one.crossJoin(spark.range(30_000)).selectExpr(
        "*", "concat('u', id) AS user_id", f"{T0} + (id % 50) * {MINUTE} AS event_timestamp_ms")
    row = users_by_span(per_window(many)).first()
    assert abs(row.estimated_users - 30_000) <= row.error_bound <= 2_200


def test_products_are_exact_where_they_fit(make):
    names = ["a", "b", "b", "c", "c", None, "", "a", "d"]
    rows = [{"timestamp": T0 + n * MINUTE, "product_id": name} for n, name in enumerate(names)]
    found = top_products_by_span(per_window(stored(make(*rows))), k=3)
    assert [tuple(r)[1:] for r in found.orderBy("rank").collect()] == [(1, "a", 2, 0), (2, "b", 2, 0), (3, "c", 2, 0)]


def test_a_window_without_products_and_one_with(make):
    rows = [{"event_type": "search", "product_id": None}, {"timestamp": T0 + MINUTE, "product_id": "x"}]
    found = per_window(stored(make(*rows)))
    assert [tuple(r) for r in top_products_by_span(found).collect()] == [(DAY, 1, "x", 1, 0)]
    assert united(found).count() == 1
    alone = found.where("product_events = 0")
    assert alone.count() == 1 and top_products_by_span(alone).count() == 0


def test_products_beyond_the_sketch_keep_the_bound(make, spark):
    one = stored(make({})).drop("product_id", "event_timestamp_ms")
    # Product n of 500 comes 6000 / n times; the sketch tells 96 apart.
    counts = Counter({f"p{n}": 6_000 // n for n in range(1, 501)})
    rows = spark.createDataFrame(list(counts.items()), "product_id string, times int").repartition(4)
    spread = rows.selectExpr("product_id", "explode(sequence(1, times)) AS i").selectExpr(
        "product_id", f"{T0} + (i % 5) * {MINUTE} AS event_timestamp_ms")
    found = top_products_by_span(per_window(one.crossJoin(spread), tracked=96), k=5, tracked=96).orderBy("rank").collect()
    total = sum(counts.values())
    assert [r.error_bound for r in found] == [math.ceil(3.5 / 128 * total)] * 5
    for r in found:
        assert counts[r.product_id] <= r.n <= counts[r.product_id] + r.error_bound
    assert {p for p, n in counts.items() if n > found[0].error_bound} <= {r.product_id for r in found}


def rows_of(kept):
    return {r.window_start: r for r in kept.read().drop("users", "products", "products_seen").collect()}


def test_refresh_counts_only_what_differs(tables, make, spark):
    kept = Sketches(tables)
    tables.insert(stored(make({"event_id": "a"}, {"event_id": "b", "timestamp": T0 + MINUTE}, {"event_id": "c", "timestamp": T0 + DAY_MS})), EVENTS)
    kept.refresh()
    before = rows_of(kept)
    assert sorted(r.event_count for r in before.values()) == [1, 1, 1]
    assert kept.differing().count() == 0
    files = set(kept.read().inputFiles())
    kept.refresh()
    assert set(kept.read().inputFiles()) == files
    # A late event and one that is stored already: one minute of the first day differs, the second day is left alone.
    tables.insert(stored(make({"event_id": "a"}, {"event_id": "late", "timestamp": T0 + 1, "user_id": "other"})), EVENTS)
    assert [r[0] for r in kept.differing().collect()] == [T0 - T0 % MINUTE]
    kept.refresh()
    after = rows_of(kept)
    assert after[T0 - T0 % MINUTE].event_count == 2 and len(after) == 3
    assert {s: r for s, r in after.items() if s != T0 - T0 % MINUTE} == {s: r for s, r in before.items() if s != T0 - T0 % MINUTE}
    assert len(files & set(kept.read().inputFiles())) == 1
    assert users_by_span(kept.read()).orderBy("window_start").first().estimated_users == 2


def test_differing_reads_neither_events_nor_sketches(tables, make):
    kept = Sketches(tables)
    tables.insert(stored(make({})), EVENTS)
    kept.refresh()
    plan = kept.differing()._jdf.queryExecution().executedPlan().toString()
    assert "event_id" not in plan and "users" not in plan and "products" not in plan


def test_windows_of_other_length(tables, make):
    kept = Sketches(tables, 5 * MINUTE)
    tables.insert(stored(make({}, {"timestamp": T0 + 5 * MINUTE}, {"timestamp": T0 + 5 * MINUTE + 1})), EVENTS)
    kept.refresh()
    assert sorted(r.event_count for r in rows_of(kept).values()) == [1, 2] and kept.differing().count() == 0
    with pytest.raises(ValueError):
        Sketches(tables, 7 * MINUTE)


def test_job_and_reports(tables, make, capsys):
    tables.insert(stored(make({"user_id": "u1"}, {"user_id": "u2", "timestamp": T0 + MINUTE})), EVENTS)
    jobs.main(["sketch", "--tables", tables.root])
    assert [tuple(r) for r in jobs.report(tables, "users_by_span", span_ms=DAY_MS).collect()] == [(DAY, 2, 2, 1)]
    capsys.readouterr()
    jobs.main(["report", "--tables", tables.root, "--name", "top_products_by_span", "--k", "1"])
    assert capsys.readouterr().out.splitlines()[1:] == [f"{DAY}\t1\trake-3\t2\t0"]
