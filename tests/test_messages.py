"""Topic messages, Avro schemas, settings."""

from __future__ import annotations

import json

from conftest import T0
from pyspark.sql import functions as F

from clickloom.config import Settings
from clickloom.operators import chain, windows
from clickloom.schemas import EVENT_AVRO, EVENT_SCHEMA, METRICS_AVRO, PER_MINUTE
from clickloom.sinks import messages
from clickloom.sources.topics import decode_metrics, topic_options


def test_events_are_keyed_by_user(make):
    rows = messages.event_messages(make({"user_id": "u1"}, {"user_id": None})).orderBy("key").collect()
    assert [r.key for r in rows] == ["u1", "unknown"]
    assert set(json.loads(rows[0].value)) == set(EVENT_SCHEMA.fieldNames())


def test_rows_that_cannot_be_encoded(make):
    fit, unfit = messages.split_encodable(make({}, {"event_type": "INVALID"}, {"user_id": None}, {"geo_country": None},
                                               {"event_type": "purchase", "price_cents": -5}))
    assert sorted(r.event_id for r in fit.collect()) == ["e0", "e4"]
    assert {r.event_id: r.error_reason for r in unfit.collect()} == {
        "e1": "Serialization error: Invalid event_type: INVALID",
        "e2": "Serialization error: Missing required fields: ['user_id']",
        "e3": "Serialization error: value does not fit the schema"}


def test_metrics_round_trip(make):
    table = windows.tumbling(chain.process(make({}, {"timestamp": T0 + 1})), 60, PER_MINUTE)
    sent = messages.metric_messages(table)
    assert [r.key for r in sent.collect()] == [PER_MINUTE]
    back = decode_metrics(sent, "json")
    assert back.drop("emitted_at").collect() == table.collect()
    assert back.where(F.col("emitted_at") > 1_700_000_000_000).count() == 1


def test_avro_schemas():
    event = {f["name"]: f for f in json.loads(EVENT_AVRO)["fields"]}
    assert event["event_id"] == {"name": "event_id", "type": "string"}
    assert event["price_cents"] == {"name": "price_cents", "type": ["null", "long"], "default": None}
    assert event["quantity"]["type"] == ["null", "int"] and event["geo_country"]["default"] == "US"
    assert event["event_type"]["type"]["symbols"][0] == "page_view" and event["event_type"]["type"]["name"] == "EventType"
    metric = {f["name"]: f for f in json.loads(METRICS_AVRO)["fields"]}
    assert metric["top_products"] == {"name": "top_products", "type": {"type": "array", "items": "string"}, "default": []}
    assert metric["page_views"] == {"name": "page_views", "type": "long", "default": 0} and "emitted_at" in metric


def test_settings_from_the_session(spark):
    assert Settings.from_session(spark) == Settings()
    spark.conf.set("spark.clickloom.minute_seconds", "30")
    spark.conf.set("spark.clickloom.encoding", "avro")
    try:
        assert Settings.from_session(spark) == Settings(minute_seconds=30, encoding="avro")
    finally:
        spark.conf.unset("spark.clickloom.minute_seconds")
        spark.conf.unset("spark.clickloom.encoding")


def test_topic_options():
    options = topic_options(Settings(), "clickstream.events", "earliest")
    assert options["subscribe"] == "clickstream.events" and options["startingOffsets"] == "earliest"
