"""Row rules: validation, bots, normalization, enrichment, and the chain."""

from __future__ import annotations

import json

import pytest
from conftest import BASE, T0, by_id

from clickloom.operators import chain
from clickloom.schemas import EVENT_TYPES, RAW_SCHEMA
from clickloom.sources.decode import decode_json

PURCHASE = {"event_type": "purchase"}

VALIDATION = [
    ({}, None),
    ({"user_id": None}, "Missing required fields: ['user_id']"),
    ({"user_id": None, "page_url": None}, "Missing required fields: ['page_url', 'user_id']"),
    ({"event_type": "INVALID"}, "Invalid event_type: INVALID"),
    ({"event_type": None}, "Invalid event_type: None"),
    ({"timestamp": -100}, "Invalid timestamp: -100"),
    ({"timestamp": 0}, "Invalid timestamp: 0"),
    ({"timestamp": None}, "Invalid timestamp: None"),
    ({"timestamp": 253_402_300_799_999}, None),
    ({"timestamp": 253_402_300_800_000}, "Invalid timestamp: 253402300800000"),
    ({**PURCHASE, "price_cents": -500}, "Negative price_cents: -500"),
    ({**PURCHASE, "price_cents": 1000, "quantity": 0}, "Invalid quantity: 0"),
    ({**PURCHASE, "price_cents": 5000, "quantity": 2}, None),
    ({**PURCHASE, "price_cents": 0}, None),
    ({**PURCHASE, "price_cents": None, "quantity": None}, None),
    ({**PURCHASE, "price_cents": -1, "quantity": 0}, "Negative price_cents: -1"),
    ({**PURCHASE, "price_cents": 2**62, "quantity": 4}, f"Revenue out of range: {2**62} * 4"),
    ({"price_cents": -500}, None),
    ({"quantity": 0}, None),
    ({"event_type": "INVALID", "timestamp": -1, "user_agent": "bot"}, "Invalid event_type: INVALID"),
    ({"geo_country": None}, None),
    *[({"event_type": t, "price_cents": 1000}, None) for t in EVENT_TYPES],
]


def test_validation(make):
    found = by_id(chain.validate(make(*[c for c, _ in VALIDATION])), "error_reason")
    assert [found[f"e{n}"] for n in range(len(VALIDATION))] == [reason for _, reason in VALIDATION]


def test_valid_rows_are_those_without_reason(make):
    rows = make(*[c for c, _ in VALIDATION])
    expected = {f"e{n}" for n, (_, reason) in enumerate(VALIDATION) if reason is None}
    assert set(by_id(chain.only_valid(rows), "event_type")) == expected


BOTS = [
    ("Mozilla/5.0 (Windows NT 10.0)", False), ("Googlebot/2.1 (+http://www.google.com/bot.html)", True),
    ("Mozilla/5.0 (compatible; YandexBot/3.0)", True), ("curl/7.88.1", True), ("Wget/1.2", True), ("python-HTTPX/0.2", True),
    ("Scrapy/2", True), ("my SPIDER", True), ("a crawler", True), ("", False),
]


def test_bots(make):
    rows = make(*[{"user_agent": agent} for agent, _ in BOTS])
    assert set(by_id(chain.filter_bots(rows), "user_id")) == {f"e{n}" for n, (_, bot) in enumerate(BOTS) if not bot}
    reasons = by_id(chain.checked(rows), "error_reason")
    assert [reasons[f"e{n}"] == "Filtered as bot traffic" for n in range(len(BOTS))] == [bot for _, bot in BOTS]


@pytest.mark.parametrize("column, values", [
    ("geo_country", [("us", "US"), (" de\t", "DE"), ("", "UNKNOWN"), (None, "UNKNOWN"), (" \t ", "UNKNOWN")]),
    ("search_query", [(" Garden HOSE 20m ", "garden hose 20m"), ("\tTab\n", "tab"), (" Wide　", "wide"),
                      (None, None), ("", "")]),
])
def test_normalization(make, column, values):
    found = by_id(chain.normalize(make(*[{column: v} for v, _ in values])), column)
    assert [found[f"e{n}"] for n in range(len(values))] == [v for _, v in values]


def test_enrichment(make):
    cases = [
        ({**PURCHASE, "price_cents": 137, "quantity": 6}, 822), ({}, 0), ({**PURCHASE, "price_cents": None}, 0),
        ({**PURCHASE, "quantity": None}, 0), ({**PURCHASE, "price_cents": 2**40, "quantity": 1000}, 2**40 * 1000),
    ]
    found = by_id(chain.enrich(make(*[c for c, _ in cases])), "revenue_cents")
    assert [found[f"e{n}"] for n in range(len(cases))] == [revenue for _, revenue in cases]


@pytest.mark.parametrize("ms, hour", [(T0, 8), (1, 0), (86_399_999, 23), (86_400_000, 0), (253_402_300_799_999, 23)])
def test_event_hour(make, ms, hour):
    assert by_id(chain.enrich(make({"timestamp": ms})), "event_hour") == {"e0": hour}


def test_mobile(make):
    agents = [("Mozilla/5.0 (iPhone; CPU iPhone OS 17_3 like Mac OS X)", True), ("Android 14 Chrome/121 Mobile", True),
              ("iPad", True), ("Mozilla/5.0 (Windows NT 10.0; Win64; x64)", False), ("", False)]
    found = by_id(chain.enrich(make(*[{"user_agent": a} for a, _ in agents])), "is_mobile")
    assert [found[f"e{n}"] for n in range(len(agents))] == [m for _, m in agents]


def test_chain(make):
    rows = make({**PURCHASE, "price_cents": 405, "quantity": 7, "geo_country": "us"}, {"user_agent": "Googlebot/2.1"},
                {"timestamp": 0})
    good = chain.process(rows)
    assert by_id(good, "revenue_cents") == {"e0": 2835}
    first = good.first()
    assert first["geo_country"] == "US"
    assert first["page_url"] == BASE["page_url"] and first["user_id"] == BASE["user_id"]
    assert by_id(chain.rejected(chain.checked(rows)), "error_reason") == {
        "e1": "Filtered as bot traffic", "e2": "Invalid timestamp: 0"}


def test_both_ways_to_good_rows_agree(make):
    rows = make(*[c for c, _ in VALIDATION], *[{"user_agent": a} for a, _ in BOTS])
    short = chain.process(rows)
    long = chain.refine(chain.accepted(chain.checked(rows))).select(short.columns)
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect()))


def _raw(spark, *values: bytes):
    rows = [(bytearray(v), "t", 0, n) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_decoding(spark):
    full = dict(BASE)
    absent_country = {k: v for k, v in full.items() if k != "geo_country"}
    null_country = {**full, "geo_country": None}
    values = [
        json.dumps(full).encode(), json.dumps(full)[:50].encode(), b"\xff\xfe", b"", b"[]", b"null", b"17",
        json.dumps({**full, "timestamp": "soon"}).encode(),
        json.dumps({"event_id": "x", "event_type": "page_view"}).encode(),
        json.dumps(absent_country).encode(), json.dumps(null_country).encode(),
        json.dumps({**full, "more": 1}).encode(),
    ]
    checked = chain.checked(decode_json(_raw(spark, *values)))
    found = {r["source_offset"]: r["error_reason"] for r in checked.collect()}
    broken = "Deserialization error: value does not match the event schema"
    assert found == {
        0: None, 1: broken, 2: "Deserialization error: value is not UTF-8 text", 3: broken, 4: broken, 5: broken, 6: broken,
        7: broken,
        8: "Missing required fields: ['geo_country', 'ip_address', 'page_url', 'session_id', 'timestamp', "
           "'user_agent', 'user_id']",
        9: "Missing required fields: ['geo_country']", 10: None, 11: None,
    }
    good = chain.process(decode_json(_raw(spark, *values)))
    assert {r["source_offset"]: r["geo_country"] for r in good.collect()} == {0: "CA", 10: "UNKNOWN", 11: "CA"}
