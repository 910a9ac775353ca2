"""Staging, marts and quality checks on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as fx
from tidemark.operators import quality
from tidemark.operators.latest import latest_per_key
from tidemark.plans import marts, staging
from tidemark.topics import CLICKS, INVENTORY, ORDERS

AS_OF = "2024-02-01 00:00:00"


def frame(spark, topic, *records):
    schema = topic.table_schema
    base = {"source_topic": topic.name}
    full = [tuple({**base, **r}.get(n) for n in schema.names) for r in records]
    text = ", ".join(
        f"{f.name} {'string' if 'timestamp' in f.dataType.simpleString() or f.dataType.simpleString() == 'date' else f.dataType.simpleString()}"
        for f in schema.fields
    )
    df = spark.createDataFrame(full, text)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def test_stg_orders_cleans_and_keeps_raw_semantics(spark):
    raw = frame(
        spark, ORDERS,
        {"order_id": "1", "amount": 1.005, "event_time": "2024-01-07T13:45:10.5",
         "ingested_at": "2024-01-08 00:00:00", "currency": "usd", "status": "placed"},
        {"order_id": "2", "amount": -1.0, "ingested_at": "2024-01-08 00:00:00"},
        {"order_id": None, "amount": 3.0, "ingested_at": "2024-01-08 00:00:00"},
    )
    (r,) = staging.stg_orders(raw).collect()
    assert (r.amount, r.currency, r.status, r.region, r.payment_method) == (
        1.01, "USD", "PLACED", "XX", "unknown",
    )
    assert r.quantity == 1 and r.total_value is None  # no raw quantity, no total
    assert (str(r.event_hour), str(r.event_date), r.hour_of_day) == (
        "2024-01-07 13:00:00", "2024-01-07 00:00:00", 13,
    )
    assert len(r) == 18


def test_stg_clickstream_conversion_is_case_sensitive(spark):
    raw = frame(
        spark, CLICKS,
        *[{"session_id": a, "user_id": "u", "action": a, "ingested_at": AS_OF, "duration_ms": 1235}
          for a in ("purchase", "PURCHASE", "add_to_cart", "view")],
        {"session_id": "none", "user_id": "u", "ingested_at": AS_OF},
        {"session_id": "no user", "ingested_at": AS_OF},
    )
    got = {r.session_id: r for r in staging.stg_clickstream(raw).collect()}
    assert {k for k, r in got.items() if r.is_conversion_action} == {"purchase", "add_to_cart"}
    assert got["purchase"].duration_sec == 1.24 and got["none"].duration_sec is None
    assert got["none"].duration_ms == 0 and "no user" not in got


def test_stg_inventory_bins_and_defaults(spark):
    stock = (0, 49, 50, 199, 200, 499, 500)
    raw = frame(
        spark, INVENTORY,
        *[{"sku": str(n), "warehouse_id": "w", "stock_level": n, "unit_cost": 2.345} for n in stock],
        {"sku": "x", "warehouse_id": "w", "stock_level": -1},
    )
    got = {r.stock_level: r for r in staging.stg_inventory(raw).collect()}
    assert [got[n].stock_status for n in stock] == [
        "CRITICAL", "CRITICAL", "LOW", "LOW", "MEDIUM", "MEDIUM", "HEALTHY",
    ]
    assert (got[50].available_qty, got[50].restock_flag, got[50].unit_cost) == (50, False, 2.35)


def test_latest_ties_do_not_depend_on_partitions(spark, rows):
    df = spark.createDataFrame(
        [("k", "2024-01-01", v) for v in range(20)] + [("one", "2024-01-01", 5), (None, "2024-01-01", 6)],
        "k string, t string, v int",
    )
    results = [
        rows(latest_per_key(df.repartition(n), ["k"], "t")) for n in (1, 3, 7)
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == 3
    assert rows(latest_per_key(df, ["k"], "t", ["v"]), "k", "v") == [("k", 19), ("one", 5), (None, 6)]


def test_latest_limits_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS t")
    plan = latest_per_key(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def profiles(spark, *rows_):
    df = spark.createDataFrame(
        list(rows_), "profile_id long, topic string, batch_id long, record_count long, profile_ts string"
    )
    return df.select(
        "*", F.lit(0.1).alias("null_rate_avg"), F.lit(0.5).alias("null_rate_max"),
        F.lit("a").alias("schema_hash"), F.lit(3).alias("column_count"),
        F.when(F.col("batch_id") == 2, "b").alias("expected_schema_hash"),
        F.lit("{}").alias("null_rates_json"), F.col("profile_ts").cast("timestamp_ntz").alias("created_at"),
    )


def anomalies(spark, *rows_):
    df = spark.createDataFrame(
        list(rows_),
        "anomaly_id long, profile_id long, topic string, batch_id long, anomaly_score double, "
        "severity string, is_schema_drift boolean, scored_at string",
    )
    return df.withColumn("created_at", F.col("scored_at").cast("timestamp_ntz"))


def test_health_sla_below_zero_and_lost_anomaly_days(spark):
    stg_p = staging.stg_stream_profiles(
        profiles(spark, (1, "t", 1, 100, "2024-01-01 01:00:00"), (2, "t", 2, 50, "2024-01-01 02:00:00"))
    )
    stg_a = staging.stg_anomaly_log(
        anomalies(
            spark,
            *[(i, i, "t", i, -0.3, "HIGH", i == 1, "2024-01-01T05:00:00") for i in (1, 2, 3)],
            (9, 9, "t", 9, -0.5, "CRITICAL", False, "2024-01-02T05:00:00"),
        )
    )
    (r,) = marts.mart_pipeline_health(stg_p, stg_a, AS_OF).collect()
    assert (r.total_batches, r.total_records, r.avg_batch_size) == (2, 150, 75.0)
    assert (r.anomaly_count, r.high_anomalies, r.schema_anomalies) == (3, 3, 1)
    assert r.pipeline_sla_pct == -50.0 and r.schema_drift_events == 1
    assert (r.avg_null_pct, r.max_null_pct) == (10.0, 50.0)


def test_anomaly_summary(spark):
    log = anomalies(
        spark,
        (1, 1, "t", 1, -0.3, "HIGH", True, "2024-01-01T05:00:00"),
        (2, 2, "t", 1, -0.4, "HIGH", False, "2024-01-01T06:00:00"),
    )
    (r,) = marts.mart_anomaly_summary(staging.stg_anomaly_log(log), AS_OF).collect()
    assert (r.anomaly_count, r.avg_score, r.min_score, r.affected_batches, r.schema_drift_count) == (
        2, -0.35, -0.4, 1, 1,
    )
    assert str(r.first_seen) == "2024-01-01 05:00:00"


def test_overview_keeps_the_orders_keyed_join(spark):
    clicks = frame(spark, CLICKS, {"session_id": "s", "user_id": "u", "event_time": "2024-01-05 01:00:00",
                                   "ingested_at": AS_OF})
    stock = frame(spark, INVENTORY, {"sku": "k", "warehouse_id": "w", "stock_level": 1,
                                     "event_time": "2024-01-05 02:00:00", "ingested_at": AS_OF})
    orders = frame(spark, ORDERS, {"order_id": "1", "customer_id": "c", "amount": 10.0, "quantity": 2,
                                   "status": "delivered", "event_time": "2024-01-04 02:00:00",
                                   "ingested_at": AS_OF})
    df = marts.mart_stream_overview(
        staging.stg_orders(orders), staging.stg_clickstream(clicks), staging.stg_inventory(stock), AS_OF
    )
    got = sorted(
        (str(r.stat_date)[:10], r.total_orders, r.total_sessions, r.unique_skus_tracked, r.total_gmv)
        for r in df.collect()
    )
    assert got == [("2024-01-04", 1, 0, 0, 20.0), ("2024-01-05", 0, 0, 1, 0.0), ("2024-01-05", 0, 1, 0, 0.0)]


def test_severity_limits(spark):
    scores = [-0.40, -0.400001, -0.25, -0.250001, -0.15, -0.150001, 0.1]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    assert [r[0] for r in df.select(fx.severity_of("s")).collect()] == [
        "HIGH", "CRITICAL", "MEDIUM", "HIGH", "NORMAL", "MEDIUM", "NORMAL",
    ]


def test_sla_band_limits(spark):
    df = spark.createDataFrame([(99.0,), (98.99,), (95.0,), (94.99,), (None,)], "s double")
    assert [r[0] for r in df.select(fx.sla_band("s")).collect()] == [
        "green", "amber", "amber", "red", "red",
    ]


def test_rounding_has_no_size_limit(spark):
    df = spark.createDataFrame([(2.5, 2.675), (float("nan"), 1e30), (-0.5, 0.00000000000125)], "x double, y double")
    got = df.select(fx.round_to("x", 0).alias("x"), fx.round_to("y", 2).alias("y")).collect()
    assert [got[0].x, got[2].x] == [3.0, -1.0] and got[1].x != got[1].x
    assert [r.y for r in got] == [2.68, 1e30, 0.0]
    assert df.select(fx.round_to("y", 14)).collect()[2][0] == 1.25e-12


def test_time_functions_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string")  # skipped hour there
        ts = fx.text_to_ts("t")
        r = df.select(ts.cast("string"), fx.hour_start_of(ts).cast("string"), F.hour(ts), fx.weekday_of(ts)).first()
        assert tuple(r) == ("2024-03-10 02:30:00", "2024-03-10 02:00:00", 2, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quality_checks_in_one_pass(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "X"), ("a", -1.0, "Y"), (None, None, None), (None, 2.0, "X")], "k string, n double, s string"
    )
    checks = [
        quality.unique("k"), quality.not_null("k"), quality.expression("n", ">= 0"),
        quality.accepted("s", ["X"]), quality.unique("s"),
    ]
    got = {(r.check_kind, r.column_name): (r.violations, r.passed) for r in quality.run_checks(df, "t", checks).collect()}
    assert got == {
        ("unique", "k"): (1, False), ("not_null", "k"): (2, False), ("expression", "n"): (1, False),
        ("accepted_values", "s"): (1, False), ("unique", "s"): (1, False),
    }
    with pytest.raises(quality.QualityError) as e:
        quality.require_passed(quality.run_checks(df, "t", checks[:1]))
    assert e.value.failures == [("t", "unique", "k", 1)]


def test_quality_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, n double")
    checks = [quality.unique("k"), quality.not_null("n")]
    assert all(r.passed for r in quality.run_checks(df, "t", checks).collect())


def test_declared_checks():
    assert sum(len(c) for c in quality.CHECKS.values()) == 22
