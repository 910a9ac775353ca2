import pytest
from pyspark.sql import functions as F

from tidemark.plans import reports as rp

DAY = "2024-01-10"


@pytest.fixture
def health(spark):
    rows = [
        ("a", "2024-01-09", 10, 1, 1, 90.0, 1.5, 0), ("b", "2024-01-09", 20, 0, 0, 99.5, 2.5, 1),
        ("a", "2024-01-10", 30, 2, 0, 95.0, 0.5, 0), ("a", "2024-01-01", 40, 0, 0, 100.0, 0.0, 0),
    ]
    df = spark.createDataFrame(
        rows, "topic string, d string, total_records long, anomaly_count long, critical_anomalies long, "
        "pipeline_sla_pct double, avg_null_pct double, schema_drift_events long"
    )
    return df.withColumn("stat_date", F.col("d").cast("timestamp_ntz")).drop("d")


def log(spark, *rows):
    df = spark.createDataFrame(
        list(rows), "anomaly_id long, profile_id long, topic string, batch_id long, anomaly_score double, "
        "severity string, is_schema_drift boolean, scored_at string"
    )
    return df.withColumn("created_at", F.col("scored_at").cast("timestamp_ntz"))


def test_status_and_missing_date(health):
    assert [(r.topic, r.total_records) for r in rp.pipeline_status(health, "2024-01-09").collect()] == [
        ("a", 10), ("b", 20),
    ]
    with pytest.raises(rp.NoData):
        rp.require_rows(rp.pipeline_status(health, "2020-01-01"), "2020-01-01")


def test_history_window_and_order(health):
    got = [(r.stat_date, r.topic) for r in rp.pipeline_history(health, f"{DAY} 15:00:00", 1).collect()]
    assert got == [("2024-01-10 00:00:00", "a"), ("2024-01-09 00:00:00", "a"), ("2024-01-09 00:00:00", "b")]


def test_summary_of_a_day_and_of_nothing(health):
    r = rp.system_summary(health, "2024-01-09").first()
    assert (r.total_records_today, r.total_anomalies_today, r.avg_sla_today) == (30, 1, 94.75)
    assert rp.system_summary(health, "2020-01-01").first().total_records_today is None


def test_sla_report_is_about_the_day_before(health):
    got = rp.sla_report(health, f"{DAY} 06:00:00").collect()
    assert [(r.topic, r.sla_band, r.overall_sla) for r in got] == [("a", "red", 99.5), ("b", "green", 99.5)]


def test_recent_anomalies_filters(spark):
    df = log(
        spark,
        (1, 1, "a", 1, -0.3, "HIGH", False, "2024-01-10T11:00:00"),
        (2, 2, "b", 1, -0.5, "CRITICAL", False, "2024-01-10T10:00:00"),
        (3, 3, "a", 1, -0.3, "HIGH", False, "2024-01-08T10:00:00"),
        (4, 4, "a", 1, -0.3, "HIGH", False, "2024-01-10T11:00:00"),
    )
    at = "2024-01-10 12:00:00"
    assert [r.anomaly_id for r in rp.recent_anomalies(df, at).collect()] == [4, 1, 2]
    assert [r.anomaly_id for r in rp.recent_anomalies(df, at, severity="critical").collect()] == [2]
    assert [r.anomaly_id for r in rp.recent_anomalies(df, at, hours=72, topic="a", limit=2).collect()] == [4, 1]


def test_unscored_profiles_oldest_first(spark):
    profiles = spark.createDataFrame(
        [(1, "2024-01-10T11:00:00"), (2, "2024-01-10T10:30:00"), (3, "2024-01-10T11:30:00"), (4, "2024-01-10T09:00:00")],
        "profile_id long, profile_ts string",
    )
    for c in ("topic", "batch_id", "record_count", "null_rate_avg", "null_rate_max", "column_count",
              "schema_hash", "expected_schema_hash"):
        profiles = profiles.withColumn(c, F.lit("x"))
    scored = log(spark, (9, 1, "a", 1, -0.3, "HIGH", False, "2024-01-10T11:00:00"))
    got = rp.unscored_profiles(profiles, scored, "2024-01-10 12:00:00", hours=2)
    assert [r.profile_id for r in got.collect()] == [2, 3]
    assert [r.profile_id for r in rp.unscored_profiles(profiles, scored, "2024-01-10 12:00:00").collect()] == [4, 2, 3]


def test_remediation_choice(spark):
    df = log(
        spark,
        (1, 1, "a", 1, -0.3, "HIGH", True, DAY), (2, 2, "a", None, -0.2, "MEDIUM", False, DAY),
        (3, 3, "a", 1, -0.1, "NORMAL", True, DAY),
    )
    got = sorted((r.severity, r.action, r.batch_id) for r in rp.remediation_actions(df).collect())
    assert got == [("HIGH", "schema_heal", 1), ("MEDIUM", "dlq_reprocess", 0)]


def test_top_n_needs_no_full_sort(spark):
    df = log(spark, (1, 1, "a", 1, -0.3, "HIGH", True, DAY))
    plan = rp.recent_anomalies(df, DAY, limit=100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
