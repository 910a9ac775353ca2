from pyspark.sql import functions as F

from tidemark.operators import validate as v
from tidemark.sources import events
from tidemark.topics import CLICKS, INVENTORY, ORDERS

T0 = "2024-01-01 10:00:00"


def order(spark, *amounts):
    base = ("O1", "C1", "P1", 2)
    tail = ("INR", "placed", "upi", "IN", T0, T0)
    return spark.createDataFrame([(*base, a, *tail) for a in amounts], ORDERS.payload)


def test_order_amounts(spark, rows):
    df = v.with_reject_reason(order(spark, 0.0, -0.01, None, float("nan"), float("inf"), 1e30, 5.0), "order")
    found = {repr(r.amount): r.reject_reason for r in df.collect()}
    assert found == {
        "0.0": "BUSINESS_RULE_VIOLATION",
        "-0.01": "BUSINESS_RULE_VIOLATION",
        "None": "NULL_REQUIRED_FIELD",
        "nan": "BUSINESS_RULE_VIOLATION",  # no number: such an amount would make its day's totals none either
        "inf": "BUSINESS_RULE_VIOLATION",
        "1e+30": None,
        "5.0": None,
    }


def test_stock_limits(spark):
    df = spark.createDataFrame(
        [("S", "W", n, T0) for n in (-1, 0, 7)], "sku string, warehouse_id string, stock_level int, event_time string"
    )
    found = {r.stock_level: r.reject_reason for r in v.with_reject_reason(df, "inventory").collect()}
    assert found == {-1: "BUSINESS_RULE_VIOLATION", 0: None, 7: None}


def test_equal_rejects_are_kept_but_distinct_form_collapses_them(spark):
    df = order(spark, -1.0, -1.0, 4.0)
    good, bad = v.validate_and_route(df, "order", 3, T0)
    assert (good.count(), bad.count()) == (1, 2)
    assert {(r.batch_id, str(r.quarantine_ts)) for r in bad.collect()} == {(3, T0)}
    assert v.rule_rejects_distinct(df, "order").count() == 1
    candidates = df.filter("amount IS NOT NULL")
    assert candidates.subtract(candidates.filter("amount > 0")).count() == 1


def test_missing_required_column_is_skipped(spark):
    df = order(spark, 5.0).drop("region")
    assert v.with_reject_reason(df, "order").first().reject_reason is None


def test_unknown_type_has_no_rules(spark):
    good, bad = v.validate_and_route(order(spark, None), "refund", 1, T0)
    assert (good.count(), bad.count()) == (1, 0)


def test_good_and_rejected_add_up(spark):
    df = order(spark, *([1.0] * 5 + [-1.0] * 3 + [None] * 2))
    counts = {
        r.outcome: r.records for r in v.routing_counts(v.with_reject_reason(df, "order")).collect()
    }
    assert counts == {"GOOD": 5, "BUSINESS_RULE_VIOLATION": 3, "NULL_REQUIRED_FIELD": 2}


def test_no_shuffle_in_validation(spark):
    good, bad = v.validate_and_route(order(spark, 1.0, -1.0), "order", 1, T0)
    for df in (good, bad):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_parse_malformed_and_wrong_types(spark):
    raw = spark.createDataFrame(
        [("not json",), ('{"session_id":"S1","duration_ms":"x","extra":1}',), (None,)], "value string"
    )
    got = events.parse(raw, CLICKS, F.lit(T0).cast("timestamp_ntz")).collect()
    assert [r.session_id for r in got] == [None, "S1", None]
    assert [r.duration_ms for r in got] == [None, None, None]
    assert got[0].value == "not json" and str(got[0].ingested_at) == T0


def test_parse_order_metadata_and_healed_columns(spark):
    raw = spark.createDataFrame(
        [('{"order_id":"1","Coupon":{"code":"A"},"amount":2}',), ("oops",), ('{"order_id":"2"}',)],
        "value string",
    )
    df = events.parse(raw, ORDERS, F.lit(T0).cast("timestamp_ntz"), healed=["coupon"])
    got = df.collect()
    assert [r.coupon for r in got] == ['{"code":"A"}', None, None]
    assert str(got[0].ingest_date) == "2024-01-01" and got[0].source_topic == "orders_topic"
    assert set(ORDERS.expected_columns) <= set(df.columns)


def test_dead_letter_keeps_all_rows_and_hides_internal_fields(spark):
    df = order(spark, *([-1.0] * 250)).withColumn("_fault_injected", F.lit("neg_value"))
    _, bad = v.validate_and_route(df, "order", 9, T0)
    letters = v.dead_letters(bad, "order")
    assert letters.count() == 250
    first = letters.first()
    assert (first.source, first.batch_id, first.reason) == ("order", 9, "BUSINESS_RULE_VIOLATION")
    assert '"amount":-1.0' in first.record and "_fault_injected" not in first.record


def test_merge_rejects_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    assert sorted(map(tuple, v.merge_rejects(a, b).collect())) == [(1, "x", None), (2, None, "y")]


def test_retention_splits_at_ninety_days(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00",), ("2023-12-31 23:59:59",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("quarantine_ts"))
    as_of = "2024-03-31 00:00:00"  # 90 days after January 1st
    assert [str(r[0]) for r in v.retained(df, as_of).collect()] == ["2024-01-01 00:00:00"]
    assert [str(r[0]) for r in v.expired(df, as_of).collect()] == ["2023-12-31 23:59:59"]


def test_required_fields_per_topic():
    assert (len(ORDERS.required), len(CLICKS.required), len(INVENTORY.required)) == (7, 5, 4)
