"""Random events: each is good or rejected, windows and sessions partition the good ones."""

from __future__ import annotations

from conftest import T0
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.config import Settings
from clickloom.operators import chain
from clickloom.plans import metrics
from clickloom.schemas import EVENT_TYPES, PER_5_MINUTES, PER_MINUTE, SESSION

EVENT = st.fixed_dictionaries({
    "event_type": st.sampled_from([*EVENT_TYPES, "INVALID", None]),
    "timestamp": st.one_of(st.integers(T0, T0 + 4_000_000), st.sampled_from([0, -1, None])),
    "user_id": st.sampled_from(["a", "b", "", None]),
    "session_id": st.sampled_from(["s", "t"]),
    "product_id": st.sampled_from(["p", "q", "", None]),
    "price_cents": st.one_of(st.none(), st.integers(-5, 10_000)),
    "quantity": st.one_of(st.none(), st.integers(-1, 4)),
    "user_agent": st.sampled_from(["Firefox", "iPhone", "my bot", ""]),
    "geo_country": st.sampled_from(["us", " ", None]),
})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(EVENT, min_size=1, max_size=60))
def test_nothing_is_lost(make, rows):
    checked = chain.checked(make(*rows))
    good, bad = chain.refine(chain.accepted(checked)), chain.rejected(checked)
    n_good = good.count()
    assert n_good + bad.count() == len(rows)
    assert sorted(map(str, chain.process(make(*rows)).select(good.columns).collect())) == sorted(map(str, good.collect()))
    sums = {r.window_type: (r.events, r.revenue, r.purchases) for r in metrics.all_window_metrics(good, Settings()).groupBy(
        "window_type").agg(F.sum("event_count").alias("events"), F.sum("total_revenue_cents").alias("revenue"),
                           F.sum("purchases").alias("purchases")).collect()}
    revenue, purchases = good.agg(F.sum("revenue_cents"), F.count_if(F.col("event_type") == "purchase")).first()
    if n_good:
        assert sums == dict.fromkeys([PER_MINUTE, PER_5_MINUTES, SESSION], (n_good, revenue, purchases))
    else:
        assert sums == {}
