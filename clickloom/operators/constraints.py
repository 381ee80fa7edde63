"""Checks for what a relational table would enforce: NOT NULL columns and unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.measures import row_count
from clickloom.schemas import TABLE_KEYS, TABLE_SCHEMAS


def constraint_report(df: DataFrame, table: str) -> DataFrame:
    """One row per constraint of the table with the number of rows that break it."""
    keys = TABLE_KEYS[table]
    needed = [f.name for f in TABLE_SCHEMAS[table].fields if not f.nullable]
    key_null = F.lit(False)
    for name in keys:
        key_null = key_null | F.col(name).isNull()
    # Combine rows of one key first; the second step then adds up a row per key.
    per_key = df.groupBy(*keys).agg(
        row_count().alias("_rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"_null_{name}") for name in needed if name not in keys])
    totals = per_key.agg(
        F.coalesce(F.sum(F.when(~key_null, F.col("_rows") - 1)), F.lit(0)).alias("_unique"),
        *[F.coalesce(F.sum(F.when(F.col(name).isNull(), F.col("_rows")) if name in keys else F.col(f"_null_{name}")),
                     F.lit(0)).alias(f"_null_{name}")
          for name in needed])
    rows = [f"'unique', '{','.join(keys)}', _unique"]
    rows += [f"'not_null', '{name}', _null_{name}" for name in needed]
    return totals.select(
        F.lit(table).alias("table_name"),
        F.expr(f"stack({len(rows)}, {', '.join(rows)}) AS (check_name, column_name, violations)"))
