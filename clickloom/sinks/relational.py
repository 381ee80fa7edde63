"""Inserting into a relational table over JDBC. Needs the driver of the database on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.config import Settings
from clickloom.operators.dedupe import first_per_key, not_stored


def insert_jdbc(
    rows: DataFrame, url: str, table: str, keys: list[str], order: list[str], settings: Settings,
    properties: dict[str, str] | None = None,
) -> None:
    """Append the rows whose key is not in the table yet, `settings.batch_rows` per statement batch."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    stored = rows.sparkSession.read.format("jdbc").options(**options).load()
    fresh = not_stored(first_per_key(rows, keys, order), stored, keys)
    (fresh.select([c for c in rows.columns if c in stored.columns]).write.format("jdbc")
     .options(**options).option("batchsize", settings.batch_rows).mode("append").save())
