import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ranks import kth_smallest


def test_equals_the_sorted_rank_on_many_scores(spark):
    df = spark.range(300_000).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).alias("v")).persist()
    values = sorted(r.v for r in df.collect())
    for k in (1, 2, 15_000, 150_000, 299_999, 300_000):
        assert kth_smallest(df, "v", k) == values[k - 1]
    df.unpersist()


def test_ties_negative_and_extreme_longs(spark):
    make = random.Random(2)
    values = [None, None, *[make.choice([-5, 0, 0, 7]) for _ in range(50)], -(1 << 63), (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    known = sorted(v for v in values if v is not None)
    for k in range(1, len(known) + 1, 7):
        assert kth_smallest(df, "v", k, buckets=16) == known[k - 1]
    for k in (0, len(known) + 1):
        with pytest.raises(ValueError):
            kth_smallest(df, "v", k)
