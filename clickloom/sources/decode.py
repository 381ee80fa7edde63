"""Decode stage: bytes to event columns. Rows that cannot be decoded are kept, with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.barrier import once
from clickloom.operators.chain import missing_keys
from clickloom.schemas import EVENT_AVRO, EVENT_SCHEMA, REQUIRED_FIELDS, SOURCE_COLUMNS

CORRUPT = "_corrupt"
DECODE_REASON = "Deserialization error: "
NOT_TEXT = DECODE_REASON + "value is not UTF-8 text"


def decode_json(raw: DataFrame) -> DataFrame:
    """`value` holds JSON text as bytes. Adds the event columns, `decode_error` and `absent_fields`."""
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.when(F.is_valid_utf8("value"), F.col("value").cast("string"))
    parsed = once(raw.select("value", *SOURCE_COLUMNS), _event=F.from_json(text, schema, options))
    # Which keys are there matters only where a required field came out null.
    some_null = F.expr(" OR ".join(f"_event.{name} IS NULL" for name in REQUIRED_FIELDS))
    absent = F.when(some_null, missing_keys(text)).otherwise(F.array().cast("array<string>"))
    judged = once(parsed, _absent=absent)
    # No keys at all: not text, or not an object.
    bad = f"_absent IS NULL OR _event.{CORRUPT} IS NOT NULL"
    error = (f"CASE WHEN NOT is_valid_utf8(value) THEN '{NOT_TEXT}' "
             f"WHEN {bad} THEN '{DECODE_REASON}value does not match the event schema' END")
    return judged.select(
        # Fields read before the damage are not kept.
        *[F.expr(f"IF({bad}, NULL, _event.{name}) AS {name}") for name in EVENT_SCHEMA.fieldNames()],
        "value", *SOURCE_COLUMNS, F.expr(f"{error} AS decode_error"), F.expr(f"IF({bad}, NULL, _absent) AS absent_fields"),
    )


def decode_avro(raw: DataFrame, schema: str = EVENT_AVRO) -> DataFrame:
    """`value` holds schemaless Avro binary. Needs the spark-avro package on the class path.

    Avro cannot leave a field out, so there is no `absent_fields`.
    """
    from pyspark.sql.avro.functions import from_avro

    parsed = once(raw.select("value", *SOURCE_COLUMNS), _event=from_avro("value", schema, {"mode": "PERMISSIVE"}))
    # A malformed record comes out as a null struct or as one whose required fields are null.
    bad = F.col("_event").isNull() | F.col("_event.event_id").isNull()
    return parsed.select(
        *[F.col(f"_event.{f.name}").cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields],
        "value", *SOURCE_COLUMNS,
        F.when(bad, F.lit(DECODE_REASON + "value does not match the event schema")).alias("decode_error"),
    )


def decode(raw: DataFrame, encoding: str) -> DataFrame:
    return {"json": decode_json, "avro": decode_avro}[encoding](raw)
