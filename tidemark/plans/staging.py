"""Staging models: raw rows to clean, typed and deduplicated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as fx
from tidemark.operators.latest import latest_per_key

# Unique key per staging model, and the column that tells which row of a key is newest
UNIQUE_KEYS = {
    "stg_orders": ("order_id",),
    "stg_clickstream": ("session_id",),
    "stg_inventory": ("sku", "warehouse_id", "event_time"),
    "stg_stream_profiles": ("profile_id",),
    "stg_anomaly_log": ("anomaly_id",),
}
NEWEST = {
    "stg_orders": "ingested_at",
    "stg_clickstream": "ingested_at",
    "stg_inventory": None,  # all movements of the latest load that has the key
    "stg_stream_profiles": "created_at",
    "stg_anomaly_log": "created_at",
}


def stg_orders(raw: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Positive-amount orders, latest ingestion per order."""
    kept = raw.filter("order_id IS NOT NULL AND amount IS NOT NULL AND amount > 0")
    latest = latest_per_key(kept, ["order_id"], "ingested_at", tie_break)
    event_time = fx.text_to_ts("event_time")
    return latest.select(
        "order_id",
        "customer_id",
        "product_id",
        _or("quantity", 1).alias("quantity"),
        fx.round_to("amount", 2).alias("amount"),
        F.coalesce(F.upper("currency"), F.lit("INR")).alias("currency"),
        F.upper(_or("status", "UNKNOWN")).alias("status"),
        F.lower(_or("payment_method", "unknown")).alias("payment_method"),
        F.upper(_or("region", "XX")).alias("region"),
        event_time.alias("event_time"),
        fx.text_to_ts("created_at").alias("created_at"),
        "ingested_at",
        "source_topic",
        "ingest_date",
        fx.hour_start_of(event_time).alias("event_hour"),
        fx.day_of(event_time).alias("event_date"),
        F.hour(event_time).alias("hour_of_day"),
        # Uses the raw quantity: an order without one has no total.
        (F.col("amount") * F.col("quantity")).alias("total_value"),
        *_carried(raw, tie_break),
    )


def stg_clickstream(raw: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Click sessions with a user, latest ingestion per session."""
    kept = raw.filter("session_id IS NOT NULL AND user_id IS NOT NULL")
    latest = latest_per_key(kept, ["session_id"], "ingested_at", tie_break)
    event_time = fx.text_to_ts("event_time")
    return latest.select(
        "session_id",
        "user_id",
        F.lower("page").alias("page"),
        F.lower("action").alias("action"),
        F.lower(_or("device", "unknown")).alias("device"),
        F.lower(_or("browser", "unknown")).alias("browser"),
        F.lower(_or("referrer", "direct")).alias("referrer"),
        _or("duration_ms", 0).alias("duration_ms"),
        F.upper(_or("region", "XX")).alias("region"),
        event_time.alias("event_time"),
        "ingested_at",
        "source_topic",
        fx.hour_start_of(event_time).alias("event_hour"),
        fx.day_of(event_time).alias("event_date"),
        # Both use the raw columns: case matters, and a missing duration stays NULL.
        fx.is_conversion("action").alias("is_conversion_action"),
        fx.round_to(F.col("duration_ms") / F.lit(1000.0), 2).alias("duration_sec"),
        *_carried(raw, tie_break),
    )


def stg_inventory(raw: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Inventory movements with a non-negative stock level; every row is kept."""
    kept = raw.filter(
        "sku IS NOT NULL AND warehouse_id IS NOT NULL AND stock_level IS NOT NULL "
        "AND stock_level >= 0"
    )
    event_time = fx.text_to_ts("event_time")
    stock = F.col("stock_level")
    return kept.select(
        "sku",
        "warehouse_id",
        F.greatest(F.coalesce(stock, F.lit(0)), F.lit(0)).alias("stock_level"),
        _or("reserved_qty", 0).alias("reserved_qty"),
        _or("restock_flag", False).alias("restock_flag"),
        _or("restock_qty", 0).alias("restock_qty"),
        fx.round_to(_or("unit_cost", 0.0), 2).alias("unit_cost"),
        F.lower(_or("last_movement", "unknown")).alias("last_movement"),
        event_time.alias("event_time"),
        "ingested_at",
        "source_topic",
        (stock - _or("reserved_qty", 0)).alias("available_qty"),
        fx.stock_status(stock).alias("stock_status"),
        fx.day_of(event_time).alias("event_date"),
        *_carried(raw, tie_break),
    )


def stg_stream_profiles(raw: DataFrame) -> DataFrame:
    profile_ts = fx.text_to_ts("profile_ts")
    drifted = fx.is_drifted("schema_hash", "expected_schema_hash")
    return raw.filter(F.col("profile_id").isNotNull()).select(
        "profile_id",
        "topic",
        "batch_id",
        "record_count",
        "null_rate_avg",
        "null_rate_max",
        "schema_hash",
        "column_count",
        "expected_schema_hash",
        "null_rates_json",
        profile_ts.alias("profile_ts"),
        "created_at",
        drifted.alias("is_schema_drift"),
        fx.hour_start_of(profile_ts).alias("profile_hour"),
        F.hour(profile_ts).alias("hour_of_day"),
    )


def stg_anomaly_log(raw: DataFrame) -> DataFrame:
    scored_at = fx.text_to_ts("scored_at")
    return raw.filter(F.col("anomaly_id").isNotNull()).select(
        "anomaly_id",
        "profile_id",
        "topic",
        "batch_id",
        fx.round_to("anomaly_score", 6).alias("anomaly_score"),
        "severity",
        "is_schema_drift",
        scored_at.alias("scored_at"),
        "created_at",
        fx.hour_start_of(scored_at).alias("scored_hour"),
        fx.day_of(scored_at).alias("scored_date"),
        fx.severity_rank("severity").alias("severity_rank"),
    )


# Model -> (its source table, how it is built)
MODELS = {
    "stg_orders": ("orders_raw", stg_orders),
    "stg_clickstream": ("clickstream_raw", stg_clickstream),
    "stg_inventory": ("inventory_raw", stg_inventory),
    "stg_stream_profiles": ("stream_profiles", stg_stream_profiles),
    "stg_anomaly_log": ("anomaly_log", stg_anomaly_log),
}


def _or(column: str, default: object):
    return F.coalesce(F.col(column), F.lit(default))


def _carried(raw: DataFrame, tie_break: Sequence[str]) -> list[str]:
    """Columns beyond the model that stay with the row: sequence columns used for ties."""
    return [c for c in tie_break if c in raw.columns]
