"""Computing an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever is built on them.

    A filter on plain columns is pushed down with their expressions written out at every use, which
    may parse a text or lower its case dozens of times per row. A filter on the output of a generator
    is not; filters on other columns still pass it.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)).alias(*columns))
