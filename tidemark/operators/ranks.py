"""Exact order statistics of whole numbers, found by counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kth_smallest(df: DataFrame, column: str, k: int, buckets: int = 4096) -> int:
    """The k-th smallest value (from 1) of a column of longs, nulls left out.

    Each pass counts the values that are still in question by bucket, in one aggregation whose
    result has a row a bucket; a bucket is the next pass's range. Longs need six passes at most.
    df is read once a pass, so it should be stored or persisted.
    """
    c = F.col(column)
    low, high, count = df.agg(F.min(c), F.max(c), F.count(c)).first()
    if not 1 <= k <= count:
        raise ValueError(f"{count} values have no {k}-th smallest")
    while low < high:
        width = -(-(high - low + 1) // buckets)
        # through the remainder: a quotient with digits behind the point could round up
        above = c.cast("decimal(20,0)") - F.lit(str(low)).cast("decimal(20,0)")
        each = F.lit(str(width)).cast("decimal(20,0)")
        bucket = ((above - F.pmod(above, each)) / each).cast("int")
        found = df.filter(c.between(low, high)).groupBy(bucket.alias("bucket")).count().collect()
        for number, inside in sorted(map(tuple, found)):
            if inside >= k:
                break
            k -= inside
        low, high = low + number * width, min(high, low + (number + 1) * width - 1)
    return low
