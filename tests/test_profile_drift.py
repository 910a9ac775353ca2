from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.operators import drift, profile
from tidemark.topics import CLICKS, ORDERS

T0 = "2024-01-01 10:00:00"


def batches(spark):
    return spark.createDataFrame(
        [(1, None, "x"), (1, None, "y"), (1, None, None), (2, None, "x")], "batch_id long, a string, b string"
    ).withColumn("ingested_at", F.lit(T0).cast("timestamp_ntz"))


def test_profile_rates_and_all_null_column(spark):
    df = profile.profile_batches(batches(spark), "t", ["a", "b"])
    got = {r.batch_id: r for r in df.collect()}
    assert got[1].null_rates == {"a": 1.0, "b": 0.333333}
    assert (got[1].record_count, got[1].null_rate_avg, got[1].null_rate_max) == (3, 0.666667, 1.0)
    assert got[2].null_rates == {"a": 1.0, "b": 0.0} and got[2].column_count == 2
    assert got[1].profile_ts == T0 and got[1].profile_id != got[2].profile_id
    assert {(r.column_name, r.null_rate) for r in profile.null_rates_long(df.filter("batch_id = 2")).collect()} == {
        ("a", 1.0), ("b", 0.0),
    }


def test_empty_batch_has_no_profile(spark):
    assert profile.profile_batches(batches(spark).limit(0), "t", ["a", "b"]).count() == 0


def test_profile_does_not_depend_on_partitions(spark, rows):
    results = [
        rows(profile.profile_batches(batches(spark).repartition(n), "t", ["a", "b"]).drop("null_rates"))
        for n in (1, 4)
    ]
    assert results[0] == results[1]


def test_fingerprint_follows_observed_keys(spark):
    raw = spark.createDataFrame(
        [(1, '{"b":1,"a":2}'), (1, '{"a":1}'), (2, '{"a":1,"b":2,"new":3}'), (2, "junk"),
         (3, '{"a":1,"b":2,"_fault_injected":"x"}')],
        "batch_id long, value string",
    ).withColumn("ingested_at", F.lit(T0).cast("timestamp_ntz"))
    found = profile.profile_batches(raw, "t", ["value"], shape=profile.shape_of("value"), also=["m"])
    got = {r.batch_id: r for r in found.collect()}
    keys = {}
    for r in profile.observed_keys(raw, profile.shape_of("value"), ["m"]).collect():
        keys.setdefault(r.batch_id, set()).add(r.key)
    assert keys == {1: {"a", "b", "m"}, 2: {"a", "b", "m", "new"}, 3: {"a", "b", "m"}}
    assert {b: r.column_count for b, r in got.items()} == {1: 3, 2: 4, 3: 3}
    assert got[1].schema_hash == got[3].schema_hash != got[2].schema_hash
    (base,) = profile.baselines(found).collect()
    assert (base.baseline_batch_id, base.baseline_hash) == (1, got[1].schema_hash)


def test_fingerprints_of_given_and_observed_names_agree(spark):
    given = profile.profile_batches(batches(spark), "t", ["a", "b"]).first()
    seen = profile.profile_batches(batches(spark), "t", ["a", "b"], shape=F.lit('["b","a"]')).first()
    assert given.schema_hash == seen.schema_hash and given.column_count == seen.column_count == 2


def test_ids_sent_as_keys_are_profiled_without_gathering_them(spark):
    value = F.concat(F.lit('{"a":1,"k'), F.col("id").cast("string"), F.lit('":2}')).alias("value")
    raw = spark.range(30_000).select((F.col("id") % 2).alias("batch_id"), value, F.lit(T0).cast("timestamp_ntz").alias("ingested_at"))
    found = profile.profile_batches(raw, "t", ["value"], shape=profile.shape_of("value"), also=["m"])
    got = {r.batch_id: r for r in found.collect()}
    assert [(r.record_count, r.column_count) for r in got.values()] == [(15_000, 15_002)] * 2
    assert got[0].schema_hash != got[1].schema_hash
    assert "collect" not in found._jdf.queryExecution().executedPlan().toString()


def test_unknown_topic_has_no_expected_hash(spark):
    found = profile.profile_batches(batches(spark), "t", ["a", "b"])
    known = spark.createDataFrame([("other", "h")], "topic string, baseline_hash string")
    stored = profile.as_stored(profile.with_baseline(found, known))
    assert {r.expected_schema_hash for r in stored.collect()} == {None}
    assert stored.columns == [c.split()[0] for c in fv.STREAM_PROFILES.split(", ")]


def quarantine(spark, *texts):
    return spark.createDataFrame([(CLICKS.name, t) for t in texts], "topic string, record_json string")


def test_keys_and_new_columns(spark, rows):
    log = quarantine(spark, '{"user_id":1,"Coupon":2,"a-b":3,"a;drop":4,"_":5}', "bad", '{"coupon":1,"_fault_injected":1}')
    keys = drift.incoming_keys(log)
    assert rows(keys, "key") == [(k,) for k in sorted(["Coupon", "_", "_fault_injected", "a-b", "a;drop", "coupon", "user_id"])]
    assert rows(drift.new_columns(keys, CLICKS), "column_name", "is_safe") == [
        ("_", False), ("a-b", False), ("a;drop", False), ("coupon", True),
    ]
    assert rows(drift.new_columns(keys, CLICKS, existing=["COUPON"]).filter("is_safe")) == []
    (change,) = drift.schema_change_rows(drift.new_columns(keys, CLICKS), "clickstream_raw", 4, T0).collect()
    assert (change.new_columns, change.batch_id, change.detected_at) == (["coupon"], 4, T0)


def test_no_change_row_without_safe_columns(spark):
    keys = drift.incoming_keys(quarantine(spark, '{"a-b":1}'))
    assert drift.schema_change_rows(drift.new_columns(keys, CLICKS), "x", 1, T0).count() == 0


def test_key_report_is_per_topic_and_whole(spark):
    log = quarantine(spark, "{%s}" % ",".join(f'"k{i:03}":1' for i in range(300)))
    assert [r.key for r in drift.key_report(log, CLICKS.name).collect()] == [f"k{i:03}" for i in range(300)]
    assert drift.key_report(log, ORDERS.name).count() == 0


def test_contract_widths(spark):
    assert len(ORDERS.expected_columns) == 14 and len(CLICKS.expected_columns) == 12
