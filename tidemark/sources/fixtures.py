"""Event topics derived from the test tables, in place of live streams.

Deterministic expressions plant the faults that the operators must handle: missing fields,
rule violations, bad timestamps, repeated keys, unknown JSON keys and malformed text.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as fx
from tidemark.operators.profile import as_stored, profile_batches
from tidemark.topics import CLICKS, INVENTORY, ORDERS, Topic

SEQUENCE = "ingest_seq"  # settles ties between events with equal ingested_at


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    region_of_customer = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .select("c_custkey", "r_name")
    )
    placed = table(spark, sf_dir, "orders").join(
        region_of_customer, F.expr("o_custkey = c_custkey")
    )
    # Both sides grow with the data, so neither is ever sent whole to every task.
    lines = table(spark, sf_dir, "lineitem").hint("merge")
    lines = lines.join(placed, F.expr("l_orderkey = o_orderkey"))
    return lines.selectExpr(
        "CASE WHEN (l_orderkey * 7 + l_linenumber) % 97 <> 0 "
        "THEN concat('ORD-', l_orderkey, '-', l_linenumber) END AS order_id",
        "CASE WHEN l_orderkey % 89 <> 0 THEN concat('CUST_', o_custkey) END AS customer_id",
        "concat('PROD_', l_partkey) AS product_id",
        "CASE WHEN l_partkey % 41 <> 0 THEN cast(l_quantity AS int) END AS quantity",
        "CASE WHEN l_partkey % 53 = 0 THEN -l_extendedprice WHEN l_suppkey % 67 = 0 THEN 0D "
        "WHEN l_partkey % 59 = 0 THEN NULL ELSE l_extendedprice END AS amount",
        "CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN 'usd' "
        "ELSE 'INR' END AS currency",
        "CASE WHEN l_orderkey % 71 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN 'cancelled' "
        "WHEN l_returnflag = 'R' THEN 'returned' WHEN o_orderstatus = 'F' THEN 'delivered' "
        "WHEN o_orderstatus = 'O' THEN 'placed' ELSE 'processing' END AS status",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS payment_method",
        "lower(r_name) AS region",
        "CASE WHEN l_partkey % 61 = 0 THEN 'not-a-timestamp' ELSE cast(l_shipdate AS string) END "
        "AS event_time",
        "cast(o_orderdate AS string) AS created_at",
        "l_shipdate AS ingested_at",
        "'orders_topic' AS source_topic",
        "cast(l_shipdate AS date) AS ingest_date",
        "l_partkey * 1000000 + l_suppkey * 1000 + cast(l_quantity AS int) AS ingest_seq",
    )


def clickstream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_id % 83 <> 0 THEN concat('S', user_id, '-', cast(ts AS date)) END "
        "AS session_id",
        "CASE WHEN event_id % 79 <> 0 THEN concat('CUST_', user_id) END AS user_id",
        "CASE event_type WHEN 'view' THEN '/Home' WHEN 'click' THEN '/product' "
        "WHEN 'purchase' THEN '/checkout' WHEN 'signup' THEN '/cart' ELSE '/search' END AS page",
        "CASE WHEN event_id % 73 = 0 THEN NULL WHEN event_type = 'signup' THEN 'add_to_cart' "
        "WHEN event_type = 'error' THEN 'scroll' "
        "WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'PURCHASE' "
        "ELSE event_type END AS action",
        "CASE user_id % 4 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet' END "
        "AS device",
        "CASE WHEN cast(get_json_object(props, '$.k') AS int) % 3 <> 0 THEN 'chrome' END AS browser",
        "CASE WHEN user_id % 5 <> 0 THEN 'google' END AS referrer",
        "CASE WHEN event_id % 67 <> 0 THEN cast(floor(value * 100) AS int) END AS duration_ms",
        "CASE WHEN user_id % 7 <> 0 THEN 'in' END AS region",
        "cast(ts AS string) AS event_time",
        "ts AS ingested_at",
        "'clickstream_topic' AS source_topic",
        "event_id AS ingest_seq",
    )


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.expr("l_partkey = p_partkey"))
        .selectExpr(
            "CASE WHEN l_partkey % 89 <> 0 THEN concat('SKU_', l_partkey) END AS sku",
            "concat('WH_', l_suppkey % 10) AS warehouse_id",
            "CASE WHEN l_orderkey % 97 <> 0 THEN cast(l_quantity AS int) * 15 - 30 END "
            "AS stock_level",
            "CASE WHEN l_linenumber % 6 <> 0 THEN l_linenumber * 5 END AS reserved_qty",
            "CASE WHEN l_linenumber % 7 <> 0 THEN l_quantity < 6 END AS restock_flag",
            "CASE WHEN l_quantity < 6 THEN 500 ELSE 0 END AS restock_qty",
            "p_retailprice AS unit_cost",
            "CASE l_returnflag WHEN 'R' THEN 'Return' WHEN 'A' THEN 'adjustment' END "
            "AS last_movement",
            "cast(l_shipdate AS string) AS event_time",
            "l_shipdate AS ingested_at",
            "'inventory_topic' AS source_topic",
        )
    )


def click_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events as JSON text, some with unknown keys and some malformed."""
    return table(spark, sf_dir, "events").selectExpr(
        "'clickstream_topic' AS topic",
        "datediff(ts, DATE'2024-01-01') AS batch_id",
        "ts AS ingested_at",
        "event_id",
        """CASE WHEN event_id % 109 = 0 THEN 'not json' ELSE concat(
             '{"session_id":"S', user_id, '","user_id":"CUST_', user_id,
             '","action":"', event_type, '","duration_ms":', cast(floor(value * 100) AS int),
             CASE WHEN event_id % 101 = 0 THEN ',"new_column_v2":7' ELSE '' END,
             CASE WHEN event_id % 103 = 0 THEN ',"unexpected_field_xyz":"DRIFT_INJECTED"'
                  ELSE '' END,
             CASE WHEN event_id % 107 = 0 THEN ',"extra_metadata":{"source":"legacy_system"}'
                  ELSE '' END,
             '}') END AS value""",
    )


RAW = {ORDERS.name: orders_raw, CLICKS.name: clickstream_raw, INVENTORY.name: inventory_raw}


def batch_of(topic_name: str):
    """Batch number of a row: the day for clicks, the week for orders and inventory."""
    if topic_name == CLICKS.name:
        return F.datediff("ingested_at", F.lit("2024-01-01").cast("date"))
    days = F.datediff("ingested_at", F.lit("1995-01-01").cast("date"))
    return F.floor(days / 7).cast("int")


def raw_with_batch(spark: SparkSession, sf_dir: str, topic_name: str) -> DataFrame:
    return RAW[topic_name](spark, sf_dir).withColumn("batch_id", batch_of(topic_name))


def sent_keys(topic: Topic) -> Column:
    """The keys that a row was sent with, as text: in some click batches there is one more."""
    known = F.lit(json.dumps(topic.expected_columns))
    more = F.lit(json.dumps([*topic.expected_columns, "coupon"]))
    return F.when(F.col("batch_id") % 11 == 5, more).otherwise(known) if topic is CLICKS else known


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of all batches of the three topics, with the null rates as a map."""
    per_topic = [
        profile_batches(raw_with_batch(spark, sf_dir, t.name), t.name, t.expected_columns, shape=sent_keys(t) if t is CLICKS else None)
        for t in (ORDERS, CLICKS, INVENTORY)
    ]
    return per_topic[0].unionByName(per_topic[1]).unionByName(per_topic[2])


def stream_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored profiles; each topic's first batch is its baseline. A topic has few batches."""
    first = F.min_by("schema_hash", "batch_id").over(Window.partitionBy("topic"))
    return as_stored(profiles(spark, sf_dir).withColumn("expected_schema_hash", first))


def anomaly_log(stored_profiles: DataFrame) -> DataFrame:
    """Stand-in scores per profile, so that everything behind the model can be checked in SQL."""
    return scored_stand_in(stored_profiles).filter("anomaly_score < 0")


def scored_stand_in(stored_profiles: DataFrame) -> DataFrame:
    score = F.expr(
        "cast(round(cast(0.05D - ((batch_id * 37) % 50) / 100D AS decimal(38,10)), 6) AS double)"
    )
    return stored_profiles.withColumn("anomaly_score", score).select(
        fx.stable_id(F.lit("anomaly"), "topic", "batch_id").alias("anomaly_id"),
        "profile_id",
        "topic",
        "batch_id",
        "anomaly_score",
        fx.severity_of("anomaly_score").alias("severity"),
        (F.col("batch_id") % 9 == 0).alias("is_schema_drift"),
        F.col("profile_ts").alias("scored_at"),
        "created_at",
    )
