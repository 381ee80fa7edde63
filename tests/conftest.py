from __future__ import annotations

import pytest

from clickloom.schemas import EVENT_SCHEMA, SOURCE_FIELDS
from clickloom.session import local_session
from pyspark.sql import types as T

DESKTOP = "Mozilla/5.0 (X11; Linux x86_64; rv:126.0) Gecko/20100101 Firefox/126.0"
# 2024-05-24 08:55:30 UTC
T0 = 1_716_540_930_000

# A visitor looks at a rake.
BASE = dict(
    event_id="e0", timestamp=T0, session_id="visit-70", user_id="visitor-7", event_type="page_view",
    page_url="https://garden.example.net/tools/rake", product_category="Garden", product_id="rake-3", quantity=1, price_cents=1450,
    search_query=None, referrer="https://search.example.com/?q=rake", geo_city="Montreal", geo_country="CA",
    ip_address="203.0.113.9", user_agent=DESKTOP,
)
FULL_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, *SOURCE_FIELDS])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("8", partitions=4, memory="6g", conf={"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Raw events from overrides of one valid event; ids and offsets count up unless given."""
    def build(*overrides: dict, partitions: int = 2):
        rows = []
        for n, change in enumerate(overrides):
            row = {**BASE, "event_id": f"e{n}", "source_topic": "clickstream.events", "source_partition": 0,
                   "source_offset": n, **change}
            rows.append(tuple(row[f] for f in FULL_SCHEMA.fieldNames()))
        return spark.createDataFrame(rows, FULL_SCHEMA).repartition(partitions)

    return build


def by_id(df, column):
    return {r["event_id"]: r[column] for r in df.select("event_id", column).collect()}
