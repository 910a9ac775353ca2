"""Exact totals against fractions of the digits that the values are written with."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.operators.totals import exact_sum, mean, totals
from tidemark.plans import marts, staging
from tidemark.sources import events
from tidemark.streaming import ingest
from tidemark.topics import ORDERS

NAN, INF = float("nan"), float("inf")


def summed(spark, rows, parts=5):
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    written = {}
    for r in df.select("k", F.col("v").cast("string").alias("v")).collect():
        written.setdefault(r.k, []).append(r.v)
    found = {r.k: (r.s, r.s_count) for r in totals(df, {"k": F.col("k")}, {"s": F.col("v")}).collect()}
    return found, written


def test_sums_of_all_exponents_equal_fractions_however_rows_are_dealt(spark):
    make = random.Random(7)
    rows = []
    for k in range(40):
        for _ in range(make.randrange(25)):
            size = make.choice([0, 0, 2, 5, -13, 30, -300, 300, 15, -6, -320, 20])
            v = make.uniform(-1, 1) * 10.0**size
            rows.append((str(k), make.choice([None, v, v, v, round(v, 2)])))
    found, written = summed(spark, rows)
    assert found == summed(spark, rows[::-1], 2)[0]
    for k, texts in written.items():
        values = [Fraction(t) for t in texts if t is not None]
        assert found[k] == (float(sum(values)) if values else None, len(values)), k


@pytest.mark.parametrize(
    ("values", "want"),
    [
        ([0.1, 0.2], 0.3), ([1e30, -1e30, 4e-13], 4e-13), ([5e-324, 5e-324], 1e-323), ([-5e-324], -5e-324),
        ([1e308, 1e308], INF), ([-1e308, -1e308], -INF), ([INF, 1e308], INF), ([-INF, 1.0], -INF),
        ([1e300, -1e300], 0.0), ([9999999999999.99] * 3, 29999999999999.97), ([None, None], None), ([1e13, 1e-12], 1e13),
    ],
)
def test_sums_of_odd_values(spark, values, want):
    assert exact_sum(spark.createDataFrame([(v,) for v in values], "v double"), "v") == want


def test_nan_and_opposite_infinities_give_nan(spark):
    for values in ([NAN, 1.0], [INF, -INF], [NAN, INF, -INF, 1e30]):
        assert math.isnan(exact_sum(spark.createDataFrame([(v,) for v in values], "v double"), "v"))


def test_a_million_tiny_values_are_not_cut(spark):
    assert exact_sum(spark.range(1_000_000).select(F.lit(4e-13).alias("v")), "v") == 4e-7
    assert exact_sum(spark.range(100_000).select(F.lit(0.00004).alias("v")), "v") == 4.0


def test_all_kinds_of_totals_with_null_keys_and_odd_values(spark):
    rows = [("a", "x", 1.0, 3), ("a", "x", 1e30, None), ("a", None, NAN, 9), (None, "y", None, 4), (None, "z", 2.5, 4)]
    df = spark.createDataFrame(rows, "k string, id string, v double, n long")
    found = totals(
        df, {"k": F.col("k")}, {"s": F.col("v"), "t": F.col("n").cast("double")}, ("ids", F.col("id")),
        rows=("count", F.lit(True)), big=("count", F.col("n") > 3), n=("sum", F.col("n")), least=("min", F.col("n")), most=("max", F.col("n")),
    ).withColumn("mean_t", mean("t"))
    got = {r.k: r for r in found.collect()}
    a, none = got["a"], got[None]
    assert (a.ids, a.rows, a.big, a.n, a.least, a.most, a.t, a.s_count, a.mean_t) == (1, 3, 1, 12, 3, 9, 12.0, 3, 6.0) and math.isnan(a.s)
    assert (none.ids, none.rows, none.big, none.n, none.s, none.s_count, none.t) == (2, 2, 2, 8, 2.5, 1, 8.0)
    assert totals(df.limit(0), {"k": F.col("k")}, {"s": F.col("v")}).isEmpty() and exact_sum(df.limit(0), "v") is None


def test_a_key_gathers_a_bounded_number_of_bands(spark):
    df = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") % 7).alias("id"), F.expr("power(10D, id % 600 - 300)").alias("v"))
    found = totals(df, {"k": F.col("k")}, {"s": F.col("v")}, ("ids", F.col("id")))
    assert found.first().ids == 7
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Join" not in plan


def test_marts_take_any_amount(spark):
    raw = ['{"order_id": "%d", "customer_id": "c", "product_id": "p", "quantity": 1, "amount": %s, "status": "placed", '
           '"region": "in", "event_time": "2024-01-05T01:00:00"}' % x for x in enumerate(["NaN", "1e30", "5.5", "-Infinity", "Infinity"])]
    batch = events.parse(spark.createDataFrame([(x,) for x in raw], "value string"), ORDERS, F.lit("2024-01-06").cast("timestamp_ntz"))
    (day,) = marts.orders_daily(staging.stg_orders(batch)).collect()  # raw rows as they are, not validated
    assert day.total_orders == 4 and math.isnan(day.total_gmv)
    good = ingest.validate.good_rows(ingest.validate.with_reject_reason(batch, "order"))
    (day,) = marts.orders_daily(staging.stg_orders(good)).collect()
    assert (day.total_orders, day.total_gmv, day.avg_order_value) == (2, 1e30, 5e29)
