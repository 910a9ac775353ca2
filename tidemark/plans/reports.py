"""Read-side reports: health, anomalies, business overview, SLA, remediation.

Each takes the tables it reads plus explicit times and returns a DataFrame. Where a report
has an order, the ordered frame is returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import scalars as fx
from tidemark.operators.totals import mean, totals

HEALTH_COLUMNS = (
    "total_records", "anomaly_count", "critical_anomalies", "pipeline_sla_pct", "avg_null_pct",
    "schema_drift_events",
)


class NoData(LookupError):
    """There are no rows for the requested date."""


def pipeline_status(health: DataFrame, date: str) -> DataFrame:
    """Health of each topic on one date."""
    day = F.col("stat_date") == fx.as_of_ts(date)
    return health.filter(day).select("topic", *HEALTH_COLUMNS).orderBy("topic")


def require_rows(report: DataFrame, what: str) -> DataFrame:
    if report.isEmpty():
        raise NoData(f"no pipeline data for {what}")
    return report


def recent_anomalies(
    anomaly_log: DataFrame,
    as_of: str,
    hours: int = 24,
    severity: str = "ALL",
    topic: str = "ALL",
    limit: int | None = None,
) -> DataFrame:
    """Anomalies of the look-back window, newest first; the first `limit` of them if given."""
    scored_at = fx.text_to_ts("scored_at")
    rows = anomaly_log.filter(scored_at >= _before(as_of, hours=hours))
    if severity != "ALL":
        rows = rows.filter(F.col("severity") == severity.upper())
    if topic != "ALL":
        rows = rows.filter(F.col("topic") == topic)
    newest = rows.orderBy(scored_at.desc(), F.col("anomaly_id").desc())
    return _first(newest, limit).select(
        "anomaly_id", "topic", "severity", "anomaly_score", "is_schema_drift", "scored_at"
    )


def pipeline_history(health: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    rows = health.filter(F.col("stat_date") >= _day_before(as_of, days))
    return rows.orderBy(F.col("stat_date").desc(), "topic").select(
        "topic", _text("stat_date"), "total_records", "anomaly_count", "pipeline_sla_pct",
        "avg_null_pct", "schema_drift_events",
    )


def stream_overview(overview: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    rows = overview.filter(F.col("stat_date") >= _day_before(as_of, days))
    return rows.orderBy(F.col("stat_date").desc()).select(
        _text("stat_date"), "total_orders", "total_sessions", "total_gmv",
        "conversion_rate_pct", "critical_stock_skus",
    )


def latest_profiles(stg_profiles: DataFrame, limit: int | None = None) -> DataFrame:
    """Profiles, newest first; the first `limit` of them if given."""
    newest = stg_profiles.orderBy(F.col("profile_ts").desc_nulls_last(), F.col("profile_id").desc())
    return _first(newest, limit).select(
        "profile_id", "topic", "batch_id", "record_count",
        fx.round_to(F.col("null_rate_avg") * 100, 2).alias("null_pct"),
        "column_count", "is_schema_drift", _text("profile_ts"),
    )


def schema_changes(changes: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    rows = changes.filter(F.col("created_at") >= _before(as_of, days=days))
    return rows.orderBy(F.col("created_at").desc(), "topic").select(
        "topic", "table_name", F.array_join("new_columns", ",").alias("new_columns"),
        "batch_id", "detected_at",
    )


def system_summary(health: DataFrame, date: str) -> DataFrame:
    """Totals over all topics on one date; one row even when there is no data."""
    found = totals(
        health.filter(F.col("stat_date") == fx.as_of_ts(date)),
        {"all": F.lit(True)},
        {"sla": F.col("pipeline_sla_pct")},
        total_records_today=("sum", F.col("total_records")),
        total_anomalies_today=("sum", F.col("anomaly_count")),
        total_critical_today=("sum", F.col("critical_anomalies")),
        total_schema_drifts=("sum", F.col("schema_drift_events")),
    )
    found = found.withColumn("avg_sla_today", mean("sla")).drop("all", "sla", "sla_count")
    return found.agg(*[F.max(c).alias(c) for c in found.columns])


def sla_report(health: DataFrame, as_of: str) -> DataFrame:
    """Rows of the day before `as_of` per topic with a band, and the best SLA of that day."""
    day = health.filter(F.col("stat_date") == _day_before(as_of, 1))
    columns = [
        "topic", "total_records", "anomaly_count", "critical_anomalies", "pipeline_sla_pct",
        "avg_null_pct", "schema_drift_events",
    ]
    banded = day.select(*columns, fx.sla_band("pipeline_sla_pct").alias("sla_band"))
    # One row per topic and day: a scalar over them is small wherever it is computed.
    best = day.agg(F.greatest(F.max("pipeline_sla_pct"), F.lit(0.0)).alias("overall_sla"))
    return banded.withColumn("overall_sla", best.scalar()).orderBy("topic")


def unscored_profiles(
    profiles: DataFrame, anomaly_log: DataFrame, as_of: str, hours: int | None = None
) -> DataFrame:
    """Profiles that have no row in the log, oldest first; of the last `hours` only, if given."""
    profile_ts = fx.text_to_ts("profile_ts")
    recent = profiles if hours is None else profiles.filter(profile_ts >= _before(as_of, hours=hours))
    logged = anomaly_log.select("profile_id").filter(F.col("profile_id").isNotNull())
    waiting = recent.join(logged, "profile_id", "left_anti").select(
        "profile_id", "topic", "batch_id", "record_count", "null_rate_avg", "null_rate_max",
        "column_count", "schema_hash", "expected_schema_hash", "profile_ts",
    )
    return waiting.orderBy(profile_ts.asc(), "profile_id")


def remediation_actions(scored: DataFrame) -> DataFrame:
    """What to run per finding of MEDIUM severity or worse: heal on drift, else replay."""
    action = F.when(F.col("is_schema_drift"), fv.HEAL_ACTION).otherwise(fv.REPLAY_ACTION)
    return scored.filter(F.col("severity").isin(*fv.SEVERITY_RANK)).select(
        "topic",
        "severity",
        F.col("anomaly_score").alias("score"),
        F.coalesce("batch_id", F.lit(0)).cast("bigint").alias("batch_id"),
        action.alias("action"),
    )


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    return ordered if limit is None else ordered.limit(limit)


def _before(as_of: str, days: int = 0, hours: int = 0) -> Column:
    return fx.as_of_ts(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))


def _day_before(as_of: str, days: int) -> Column:
    return fx.day_of(_before(as_of, days=days))


def _text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)
