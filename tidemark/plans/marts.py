"""Mart models: daily health, anomaly and business aggregates.

Every stream is totalled by key on its own. What a mart brings together is then laid one below the
other and meets in one small grouping, so no mart needs a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as fx
from tidemark.operators.totals import mean, totals


def _count(condition: Column | str) -> tuple[str, Column]:
    return "count", F.col(condition) if isinstance(condition, str) else condition


def _rows() -> tuple[str, Column]:
    return "count", F.lit(True)


def _share(hits: str, rows: str) -> Column:
    return fx.round_to(F.col(hits) * F.lit(100.0) / F.nullif(F.col(rows), F.lit(0)), 2)


def _laid_together(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """A row per key with the columns of all frames, each of which has a key at most once."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return every.groupBy(*keys).agg(*[F.max(c).alias(c) for c in every.columns if c not in keys])


# --------------------------------------------------------------------------- health


def profile_days(stg_profiles: DataFrame) -> DataFrame:
    records = F.col("record_count")
    return totals(
        stg_profiles,
        {"topic": F.col("topic"), "stat_date": fx.day_of("profile_ts")},
        {"null_rate": F.col("null_rate_avg")},
        batches=_rows(),
        records=("sum", records),
        sized=_count(records.isNotNull()),
        smallest=("min", records),
        largest=("max", records),
        worst_null_rate=("max", F.col("null_rate_max")),
        drifted=_count("is_schema_drift"),
    )


def anomaly_days(stg_anomalies: DataFrame) -> DataFrame:
    severity = F.col("severity")
    return totals(
        stg_anomalies,
        {"topic": F.col("topic"), "stat_date": F.col("scored_date")},
        {"score": F.col("anomaly_score")},
        anomalies=_rows(),
        critical=_count(severity == "CRITICAL"),
        high=_count(severity == "HIGH"),
        medium=_count(severity == "MEDIUM"),
        drift_anomalies=_count("is_schema_drift"),
    )


def mart_pipeline_health(stg_profiles: DataFrame, stg_anomalies: DataFrame, as_of: str) -> DataFrame:
    """Health per topic and day. Days that only have anomalies are not reported, and anomalies
    without a topic or day belong to no profile."""
    found = anomaly_days(stg_anomalies.filter("topic IS NOT NULL AND scored_date IS NOT NULL"))
    days = _laid_together([profile_days(stg_profiles), found], ["topic", "stat_date"]).filter("batches IS NOT NULL")

    def or0(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    failed = or0("anomalies") / F.nullif(F.col("batches"), F.lit(0))
    return days.select(
        "topic",
        "stat_date",
        F.col("batches").alias("total_batches"),
        F.col("records").alias("total_records"),
        fx.round_to(F.col("records") / F.nullif(F.col("sized"), F.lit(0)), 0).alias("avg_batch_size"),
        F.col("smallest").alias("min_batch_size"),
        F.col("largest").alias("max_batch_size"),
        fx.round_to(mean("null_rate") * 100, 2).alias("avg_null_pct"),
        fx.round_to(F.col("worst_null_rate") * 100, 2).alias("max_null_pct"),
        F.col("drifted").alias("schema_drift_events"),
        or0("anomalies").alias("anomaly_count"),
        or0("critical").alias("critical_anomalies"),
        or0("high").alias("high_anomalies"),
        or0("medium").alias("medium_anomalies"),
        or0("drift_anomalies").alias("schema_anomalies"),
        fx.round_to(mean("score"), 6).alias("avg_anomaly_score"),
        fx.round_to((1 - failed) * 100, 2).alias("pipeline_sla_pct"),
        fx.as_of_ts(as_of).alias("dbt_updated_at"),
    )


def mart_anomaly_summary(stg_anomalies: DataFrame, as_of: str) -> DataFrame:
    """Anomalies per day, topic and severity."""
    scored_at = F.col("scored_at")
    found = totals(
        stg_anomalies,
        {"stat_date": F.col("scored_date"), "topic": F.col("topic"), "severity": F.col("severity")},
        {"score": F.col("anomaly_score")},
        distinct=("affected_batches", F.col("batch_id")),
        anomaly_count=_rows(),
        lowest=("min", F.col("anomaly_score")),
        schema_drift_count=_count("is_schema_drift"),
        first_seen=("min", scored_at),
        last_seen=("max", scored_at),
    )
    return found.select(
        "stat_date",
        "topic",
        "severity",
        "anomaly_count",
        fx.round_to(mean("score"), 6).alias("avg_score"),
        fx.round_to("lowest", 6).alias("min_score"),
        "schema_drift_count",
        "affected_batches",
        "first_seen",
        "last_seen",
        fx.as_of_ts(as_of).alias("dbt_updated_at"),
    )


# --------------------------------------------------------------------------- business


def orders_daily(stg_orders: DataFrame) -> DataFrame:
    """Business totals per order date. Orders are unique by order_id after staging."""
    status = F.col("status")
    found = totals(
        stg_orders,
        {"event_date": F.col("event_date")},
        {"total_gmv": F.col("total_value"), "paid": F.col("amount")},
        distinct=("unique_customers", F.col("customer_id")),
        rows=_rows(),
        total_orders=_count(F.col("order_id").isNotNull()),
        delivered=_count(status == "DELIVERED"),
        cancelled=_count(status == "CANCELLED"),
    )
    return found.select(
        "event_date",
        "total_orders",
        "unique_customers",
        "total_gmv",
        mean("paid").alias("avg_order_value"),
        _share("delivered", "rows").alias("delivery_rate_pct"),
        _share("cancelled", "rows").alias("cancellation_rate_pct"),
    )


def clicks_daily(stg_clickstream: DataFrame) -> DataFrame:
    """Session totals per day. Sessions are unique by session_id after staging."""
    found = totals(
        stg_clickstream,
        {"event_date": F.col("event_date")},
        {"seconds": F.col("duration_sec")},
        distinct=("unique_users", F.col("user_id")),
        rows=_rows(),
        total_sessions=_count(F.col("session_id").isNotNull()),
        conversion_events=_count("is_conversion_action"),
    )
    return found.select(
        "event_date",
        "total_sessions",
        "unique_users",
        "conversion_events",
        mean("seconds").alias("avg_session_sec"),
        _share("conversion_events", "rows").alias("conversion_rate_pct"),
    )


def inventory_daily(stg_inventory: DataFrame) -> DataFrame:
    available = F.col("available_qty")
    found = totals(
        stg_inventory,
        {"event_date": F.col("event_date")},
        distinct=("unique_skus_tracked", F.col("sku")),
        critical_stock_skus=_count(F.col("stock_status") == "CRITICAL"),
        restock_triggered=_count("restock_flag"),
        available=("sum", available.cast("bigint")),
        known=_count(available.isNotNull()),
    )
    return found.select(
        "event_date",
        "unique_skus_tracked",
        "critical_stock_skus",
        "restock_triggered",
        (F.col("available") / F.nullif(F.col("known"), F.lit(0))).alias("avg_available_qty"),
    )


def mart_stream_overview(
    stg_orders: DataFrame, stg_clickstream: DataFrame, stg_inventory: DataFrame, as_of: str
) -> DataFrame:
    """One row per day over the three streams.

    Clicks and inventory join a day through its orders: without orders, or without a day, each of
    them has a row of its own.
    """
    streams = {"orders": orders_daily(stg_orders), "clicks": clicks_daily(stg_clickstream), "stock": inventory_daily(stg_inventory)}
    measures = {name: [c for c in df.columns if c != "event_date"] for name, df in streams.items()}
    marked = [df.withColumn(f"has_{name}", F.lit(True)) for name, df in streams.items()]
    days = _laid_together(marked, ["event_date"])
    apart = F.filter(F.array(*[F.when(F.col(f"has_{n}"), F.array(F.lit(n))) for n in streams]), lambda x: x.isNotNull())
    together = F.col("has_orders") & F.col("event_date").isNotNull()
    rows = F.when(together, F.array(F.array(*map(F.lit, streams)))).otherwise(apart)
    held = days.withColumn("_streams", F.explode(rows))

    def or0(name: str) -> Column:
        stream = next(n for n, columns in measures.items() if name in columns)
        return F.coalesce(F.when(F.array_contains("_streams", stream), F.col(name)), F.lit(0))

    return held.select(
        F.col("event_date").alias("stat_date"),
        or0("total_orders").alias("total_orders"),
        or0("unique_customers").alias("unique_customers"),
        fx.round_to(or0("total_gmv"), 2).alias("total_gmv"),
        fx.round_to(or0("avg_order_value"), 2).alias("avg_order_value"),
        or0("delivery_rate_pct").alias("delivery_rate_pct"),
        or0("cancellation_rate_pct").alias("cancellation_rate_pct"),
        or0("total_sessions").alias("total_sessions"),
        or0("unique_users").alias("unique_users"),
        or0("conversion_rate_pct").alias("conversion_rate_pct"),
        fx.round_to(or0("avg_session_sec"), 1).alias("avg_session_sec"),
        or0("unique_skus_tracked").alias("unique_skus_tracked"),
        or0("critical_stock_skus").alias("critical_stock_skus"),
        or0("restock_triggered").alias("restock_triggered"),
        fx.as_of_ts(as_of).alias("dbt_updated_at"),
    )
