"""Connected components of an edge table, by alternating star contraction.

Every round hangs each node's larger neighbours on its smallest one, then its smaller ones. Rounds
are stored, since each reads the one before it several times and must survive lost executors. The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _hung(high: str, low: str) -> list:
    return [F.col(high).alias("hi"), F.col(low).alias("lo")]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(*_hung("v", "m")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").filter("lo > m").select(*_hung("lo", "m"))
    return moved.unionByName(least.select(*_hung("hi", "m"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each node that has an edge, as `node`, with the smallest node it is linked to, as `root`.

    Null ends and loops link nothing; edges may repeat and have either direction.
    """
    ends = [F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")]
    now = edges.filter(F.col(a) != F.col(b)).select(*ends).distinct()
    now, seen = stored(now, "links"), None
    while True:
        now = stored(_small_star(_large_star(now)), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
