"""Settings of a deployment, with overrides taken from the Spark configuration."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass

from pyspark.sql import SparkSession

PREFIX = "spark.clickloom."


@dataclass(frozen=True)
class Settings:
    # Window sizes, session gap and lateness, in seconds.
    minute_seconds: int = 60
    revenue_seconds: int = 300
    session_gap_seconds: int = 1800
    lateness_seconds: int = 30

    # Sink batch size and flush interval.
    batch_rows: int = 500
    flush_seconds: float = 5.0

    # Topic names and start position.
    bootstrap_servers: str = "kafka:9092"
    events_topic: str = "clickstream.events"
    metrics_topic: str = "clickstream.aggregated"
    dead_letter_topic: str = "clickstream.dlq"
    starting_offsets: str = "earliest"
    topic_partitions: int = 6

    # Upper bounds on what one micro-batch takes from the broker or from a folder.
    max_offsets_per_trigger: int = 5_000_000
    files_per_trigger: int = 1_000
    # Read tasks per micro-batch; more than topic partitions, so that a busy partition is split.
    min_read_tasks: int = 64
    # How messages are encoded: "json" or "avro" (needs the spark-avro package).
    encoding: str = "json"

    # Files a micro-batch writes at most per day.
    files_per_batch: int = 16
    # Buckets of event ids in the stored layout; must not change while the table lives.
    id_buckets: int = 16

    @classmethod
    def from_session(cls, spark: SparkSession) -> Settings:
        """Defaults, overridden by `spark.clickloom.<field>` where the session sets it."""
        found = {}
        for field in dataclasses.fields(cls):
            text = spark.conf.get(PREFIX + field.name, None)
            if text is not None:
                found[field.name] = type(field.default)(text)
        return cls(**found)
