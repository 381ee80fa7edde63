"""Running values over long ordered sequences without one task holding a whole sequence.

The order column is cut into blocks. Each block is summed up, the block totals are accumulated, and
every row gets what all earlier blocks of its sequence add up to (the carry). What remains for the
caller is a window inside one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"


def with_carry(
    df: DataFrame, sequence: list[str], order: str, block_size: int, carries: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add `_block` and one column per carry: name -> ("sum" | "max", expression); null in the first block.

    The columns in `sequence` and the order column must not hold nulls.
    """
    step = {"sum": F.sum, "max": F.max}
    # Never null: no null check is added to one side of the join only, so both sides share a shuffle.
    block = F.coalesce(F.floor(F.col(order) / F.lit(block_size)), F.lit(0).cast("long"))
    blocked = df.withColumn(BLOCK, block)
    totals = blocked.groupBy(*sequence, BLOCK).agg(
        *[step[kind](value).alias(name) for name, (kind, value) in carries.items()])
    earlier = Window.partitionBy(*sequence).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *sequence, BLOCK, *[step[kind](name).over(earlier).alias(name) for name, (kind, _) in carries.items()])
    return blocked.join(carried, [*sequence, BLOCK])
