"""Tables as topic messages: key and value columns, and writing them.

Writing to a topic needs the spark-sql-kafka package on the class path.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.config import Settings
from clickloom.operators import chain, dead_letters
from clickloom.schemas import (
    EVENT_AVRO, EVENT_SCHEMA, EVENT_TYPES, METRICS_AVRO, METRICS_COLUMNS, REQUIRED_FIELDS,
)


def fits_schema() -> Column:
    """Whether the Avro schema can hold an event: required fields filled, a known event type."""
    filled = reduce(and_, [F.col(name).isNotNull() for name in REQUIRED_FIELDS])
    return filled & F.col("event_type").isin(EVENT_TYPES)


def split_encodable(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events to publish, and those that cannot be encoded, with a reason for the dead letters."""
    reason = F.concat(F.lit("Serialization error: "), F.coalesce(F.col("error_reason"), F.lit("value does not fit the schema")))
    unfit = chain.validate(events.where(~F.coalesce(fits_schema(), F.lit(False)))).withColumn("error_reason", reason)
    return events.where(fits_schema()), unfit


def event_messages(events: DataFrame, encoding: str = "json") -> DataFrame:
    """Events keyed by user, so that the events of a user stay in order."""
    if encoding == "avro":
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(F.struct(*EVENT_SCHEMA.fieldNames()), EVENT_AVRO)
    else:
        value = dead_letters.event_json()
    return events.select(F.coalesce("user_id", F.lit("unknown")).alias("key"), value.alias("value"))


def metric_messages(metrics: DataFrame, encoding: str = "json") -> DataFrame:
    """Aggregates keyed by their kind, stamped with the time of emission."""
    stamped = metrics.withColumn("emitted_at", F.unix_millis(F.current_timestamp()))
    record = F.struct(*METRICS_COLUMNS, "emitted_at")
    if encoding == "avro":
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(record, METRICS_AVRO)
    else:
        value = F.to_json(record)
    return stamped.select(F.col("window_type").alias("key"), value.alias("value"))


def write_topic(messages: DataFrame, settings: Settings, topic: str) -> None:
    """Write key and value columns to a topic; for a batch, or inside foreachBatch."""
    (messages.write.format("kafka")
     .option("kafka.bootstrap.servers", settings.bootstrap_servers)
     # Acknowledgement by all replicas, 10 ms to fill a batch, snappy.
     .option("kafka.acks", "all")
     .option("kafka.linger.ms", "10")
     .option("kafka.compression.type", "snappy")
     .option("topic", topic)
     .save())
