"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the one with the greatest `newest`, ties settled by `tie_break`.

    Without `tie_break`, a hash over the whole row settles ties, so the result never depends
    on partitioning. Spark turns `row_number() = 1` into a per-task limit before the shuffle,
    which means a key that holds a large share of all rows sends one row per task.
    """
    helper = []
    if not tie_break:
        df = df.withColumn("_row_hash", F.xxhash64(*df.columns))
        tie_break, helper = ["_row_hash"], ["_row_hash"]
    newest_first = [F.col(c).desc_nulls_last() for c in (newest, *tie_break)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank", *helper)
