"""Rows that arrived after their window had closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.operators.prefix import BLOCK, with_carry

# Offsets per block: what one task sorts at a time.
ARRIVAL_BLOCK = 1_000_000


def late_events(
    events: DataFrame, seconds: int, lateness_seconds: int,
    partition: str = "source_partition", offset: str = "source_offset", block_size: int = ARRIVAL_BLOCK,
) -> DataFrame:
    """Events whose window end plus the lateness was not after the newest event time that had
    arrived before them in their source partition."""
    size, late = seconds * 1000, lateness_seconds * 1000
    # Rows without a source partition form one of their own.
    placed = events.withColumn("_source", F.coalesce(partition, F.lit(-1)))
    carried = with_carry(placed, ["_source"], offset, block_size, {"_carry_ms": ("max", F.col("timestamp"))})
    before = (Window.partitionBy("_source", BLOCK).orderBy(offset)
              .rowsBetween(Window.unboundedPreceding, -1))
    seen = carried.withColumn("newest_ms", F.greatest(F.max("timestamp").over(before), F.col("_carry_ms")))
    start = clock.floor_to(F.col("timestamp"), size)
    return (
        seen.withColumn("window_start", start)
        .withColumn("window_end", F.col("window_start") + F.lit(size).cast("long"))
        .where(F.col("window_end") + F.lit(late).cast("long") <= F.col("newest_ms"))
        .withColumn("late_by_ms", F.col("newest_ms") - F.col("timestamp"))
        .drop(BLOCK, "_carry_ms", "_source")
    )
