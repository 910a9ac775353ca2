"""One registered query per operator and report, over the event topics derived from the tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as fx
from tidemark.operators import drift, forest, profile, quality, repair, upsert, validate
from tidemark.operators.latest import latest_per_key
from tidemark.plans import jobs, marts, reports, staging
from tidemark.session import new_folder, written_to
from tidemark.sources import events, folders
from tidemark.sources import fixtures as fixture
from tidemark.sources.tables import Warehouse
from tidemark.streaming import ingest
from tidemark.streaming.latest import latest_in_stream
from tidemark.topics import CLICKS, INVENTORY, ORDERS, TOPICS, Topic

AS_OF = "2024-02-01 00:00:00"
CUTOFF = "1998-06-01 00:00:00"  # splits orders into what is staged already and what is new
ALL_DAYS = 20_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ------------------------------------------------------------------ parsing and validation


@query
def parse_events(spark, sf):
    raw = fixture.click_json(spark, sf)
    parsed = events.parse(raw, CLICKS, F.col("ingested_at"))
    return parsed.select("event_id", *CLICKS.expected_columns)


def _validated(spark, sf, topic: Topic) -> DataFrame:
    raw = fixture.raw_with_batch(spark, sf, topic.name)
    return validate.with_reject_reason(raw, topic.record_type)


def _rejects(spark, sf, topic: Topic) -> DataFrame:
    raw = fixture.raw_with_batch(spark, sf, topic.name)
    _, rejected = validate.validate_and_route(
        raw, topic.record_type, F.col("batch_id"), F.col("ingested_at")
    )
    return rejected


@query
def validate_orders(spark, sf):
    return _validated(spark, sf, ORDERS).select(
        *ORDERS.expected_columns, "ingest_seq", "batch_id", "reject_reason"
    )


@query
def validate_clicks(spark, sf):
    return _validated(spark, sf, CLICKS).select(
        *CLICKS.expected_columns, "ingest_seq", "batch_id", "reject_reason"
    )


@query
def validate_inventory(spark, sf):
    return _validated(spark, sf, INVENTORY).select(
        *INVENTORY.expected_columns, "batch_id", "reject_reason"
    )


@query
def reject_summary(spark, sf):
    return union(
        [
            validate.routing_counts(
                _validated(spark, sf, t).select("source_topic", "batch_id", "reject_reason"),
                "source_topic",
                "batch_id",
            )
            for t in TOPICS.values()
        ]
    )


@query
def rejects_except_distinct(spark, sf):
    return validate.rule_rejects_distinct(fixture.inventory_raw(spark, sf), INVENTORY.record_type)


@query
def rejects_union(spark, sf):
    rejected = _rejects(spark, sf, ORDERS)
    nulls = rejected.filter("reject_reason = 'NULL_REQUIRED_FIELD'").drop("ingest_date")
    rules = rejected.filter("reject_reason = 'BUSINESS_RULE_VIOLATION'").drop("created_at")
    return validate.merge_rejects(nulls, rules)


def _letters(spark, sf, topic: Topic) -> DataFrame:
    return validate.dead_letters(_rejects(spark, sf, topic), topic.record_type)


@query
def dlq_envelope(spark, sf):
    """Envelopes of all topics, the JSON record read back by field."""
    letters = union([_letters(spark, sf, t) for t in TOPICS.values()])

    def field(name: str):
        return F.get_json_object("record", f"$.{name}").alias(name)

    return letters.select(
        "source", "batch_id", "reason", field("order_id"), field("session_id"), field("sku"),
        field("event_time"), F.get_json_object("record", "$.amount").cast("double").alias("amount"),
        F.get_json_object("record", "$.stock_level").cast("int").alias("stock_level"),
        field("reject_reason"),
    )


@query
def quarantine_retention(spark, sf):
    quarantine = union(
        [
            _rejects(spark, sf, t).select(
                F.col("source_topic").alias("topic"), "batch_id", "reject_reason", "quarantine_ts"
            )
            for t in TOPICS.values()
        ]
    )
    return (
        validate.retained(quarantine, "2001-10-01 00:00:00")
        .groupBy("topic", "batch_id", "reject_reason")
        .agg(F.count(F.lit(1)).alias("records"), F.min("quarantine_ts").alias("oldest"))
    )


# ------------------------------------------------------------------ staging


def _stg_orders(spark, sf):
    return staging.stg_orders(fixture.orders_raw(spark, sf), [fixture.SEQUENCE])


def _stg_clicks(spark, sf):
    return staging.stg_clickstream(fixture.clickstream_raw(spark, sf), [fixture.SEQUENCE])


def _stg_inventory(spark, sf):
    return staging.stg_inventory(fixture.inventory_raw(spark, sf))


@query
def stg_orders(spark, sf):
    return _stg_orders(spark, sf).drop("ingest_seq")


@query
def stg_clickstream(spark, sf):
    return _stg_clicks(spark, sf).drop("ingest_seq")


@query
def stg_inventory(spark, sf):
    return _stg_inventory(spark, sf)


@query
def stg_stream_profiles(spark, sf):
    return staging.stg_stream_profiles(fixture.stream_profiles(spark, sf)).drop("null_rates_json")


@query
def stg_anomaly_log(spark, sf):
    return staging.stg_anomaly_log(fixture.anomaly_log(fixture.stream_profiles(spark, sf)))


@query
def scalar_timestamps(spark, sf):
    """Text times of all orders, good and bad, through every time function."""
    ts = fx.text_to_ts("event_time")
    return fixture.orders_raw(spark, sf).select(
        "ingest_seq",
        "customer_id",
        "event_time",
        ts.alias("parsed"),
        fx.hour_start_of(ts).alias("hour_start"),
        fx.day_of(ts).alias("day"),
        F.hour(ts).alias("hour"),
        fx.weekday_of(ts).alias("weekday"),
        fx.weekday_of(fx.text_to_ts("created_at")).alias("created_weekday"),
        (ts - F.make_dt_interval(F.lit(2), F.lit(3))).alias("look_back"),
    )


@query
def scalar_case(spark, sf):
    """Every band and label over the values of the inventory and click streams."""
    stock = fixture.inventory_raw(spark, sf).select(
        F.lit("stock").alias("what"),
        F.col("stock_level").cast("string").alias("value"),
        fx.stock_status("stock_level").alias("label"),
        F.lit(None).cast("int").alias("rank"),
        fx.sla_band(F.col("stock_level") / F.lit(7.0)).alias("band"),
    )
    clicks = fixture.clickstream_raw(spark, sf).select(
        F.lit("action").alias("what"),
        F.col("action").alias("value"),
        fx.is_conversion("action").cast("string").alias("label"),
        fx.severity_rank(F.upper("device")).alias("rank"),
        F.lit(None).cast("string").alias("band"),
    )
    return (
        stock.unionByName(clicks)
        .groupBy("what", "value", "label", "rank", "band")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query
def severity_bins(spark, sf):
    """Scores across all limits, including values on each limit."""
    score = (F.col("value") * 100 % 60) / F.lit(-100.0)
    return fixture.table(spark, sf, "events").select(
        "event_id",
        fx.round_to(score, 6).alias("anomaly_score"),
        fx.severity_of(fx.round_to(score, 6)).alias("severity"),
        fx.severity_rank(fx.severity_of(fx.round_to(score, 6))).alias("severity_rank"),
    )


@query
def incremental_orders(spark, sf):
    """Stage only what is newer than the newest staged row."""
    raw = fixture.orders_raw(spark, sf)
    staged = _stg_orders_until(spark, sf)
    return staging.stg_orders(upsert.newer_than(raw, staged, "ingested_at"), ["ingest_seq"]).drop(
        "ingest_seq"
    )


def _stg_orders_until(spark, sf) -> DataFrame:
    raw = fixture.orders_raw(spark, sf)
    return staging.stg_orders(raw.filter(F.col("ingested_at") <= fx.as_of_ts(CUTOFF)), ["ingest_seq"])


@query
def upsert_orders(spark, sf):
    """Merge newly staged orders, which have one more column, into those staged before."""
    raw = fixture.orders_raw(spark, sf)
    newer = staging.stg_orders(raw.filter(F.col("ingested_at") > fx.as_of_ts(CUTOFF)), ["ingest_seq"])
    newer = newer.withColumn("new_column_v2", F.concat(F.lit("v"), "hour_of_day"))
    merged = upsert.merge(_stg_orders_until(spark, sf), newer, staging.UNIQUE_KEYS["stg_orders"])
    return merged.drop("ingest_seq")


@query
def stored_upsert_orders(spark, sf):
    """Two loads through the stored table, the second with one more column."""
    raw = fixture.orders_raw(spark, sf)
    table = Warehouse(spark, new_folder(spark, "stored-orders")).staged("stg_orders")
    late = F.col("ingested_at") > fx.as_of_ts(CUTOFF)
    table.append(staging.stg_orders(raw.filter(~late), ["ingest_seq"]).drop("ingest_seq"), "1")
    newer = staging.stg_orders(raw.filter(late), ["ingest_seq"]).drop("ingest_seq")
    table.append(newer.withColumn("new_column_v2", F.concat(F.lit("v"), "hour_of_day")), "2")
    return table.read()


@query
def stored_upsert_inventory(spark, sf):
    """Movements have no unique key: the latest load replaces all rows of a key. Then folded."""
    raw = fixture.inventory_raw(spark, sf)
    table = Warehouse(spark, new_folder(spark, "stored-inventory")).staged("stg_inventory")
    late = F.col("ingested_at") > fx.as_of_ts(CUTOFF)
    table.append(staging.stg_inventory(raw.filter(~late)), "1")
    again = staging.stg_inventory(raw.filter(late | (F.col("stock_level") % 7 == 0)))
    table.append(again.withColumn("new_column_v2", F.concat(F.lit("v"), "stock_level")), "2")
    table.compact("3")
    return table.read()


@query
def backfilled_inventory_staged(spark, sf):
    """A backfill of old movements arrives after the newer ones, in a run of an earlier time: it wins.

    The days of the first load are folded in between."""
    warehouse = Warehouse(spark, new_folder(spark, "backfill"))
    raw = fixture.inventory_raw(spark, sf)
    late = F.col("ingested_at") > fx.as_of_ts(CUTOFF)
    for i, (rows, as_of) in enumerate(((raw.filter(late), "2024-02-02"), (raw.filter(~late | (F.col("stock_level") % 7 == 0)), "2024-02-01"))):
        for half in range(2):
            mine = rows.filter(F.pmod(F.xxhash64("sku", "warehouse_id", "event_time"), F.lit(2)) == half)
            warehouse.write_load(mine, "inventory_raw", f"backfill {half}", i, F.lit("2024-01-31").cast("date"))
        jobs.run_staging(warehouse, f"{as_of} 00:00:00")
        jobs.fold_closed_days(warehouse, "2024-02-01", f"{as_of} 01:00:00")
    return warehouse.read("stg_inventory")


@query
def late_profiles_staged(spark, sf):
    """Loads that arrive in another order than their times, staged after each."""
    warehouse = Warehouse(spark, new_folder(spark, "late-profiles"))
    stored = fixture.stream_profiles(spark, sf)
    for i, topic in enumerate((CLICKS, ORDERS, INVENTORY)):
        mine = stored.filter(F.col("topic") == topic.name)
        warehouse.write_load(mine, "stream_profiles", topic.name, 0, F.lit("2024-01-31").cast("date"))
        jobs.run_staging(warehouse, f"2024-02-0{i + 1} 00:00:00")
    return warehouse.read("stg_stream_profiles").drop("null_rates_json")


def _parsed(raw: DataFrame, topic: Topic) -> DataFrame:
    """Rows sent as JSON text and parsed again."""
    sent = raw.select("ingested_at", "source_topic", F.to_json(F.struct(*topic.payload.names)).alias("value"))
    return events.parse(sent, topic, F.col("ingested_at")).select(*topic.expected_columns)


@query
def parse_orders(spark, sf):
    return _parsed(fixture.orders_raw(spark, sf), ORDERS)


@query
def parse_inventory(spark, sf):
    return _parsed(fixture.inventory_raw(spark, sf), INVENTORY)


# ------------------------------------------------------------------ profiles and drift


@query
def stream_profiles(spark, sf):
    return fixture.stream_profiles(spark, sf).drop("null_rates_json")


@query
def profile_null_rates(spark, sf):
    return profile.null_rates_long(fixture.profiles(spark, sf))


def _json_profiles(spark, sf) -> DataFrame:
    raw = fixture.click_json(spark, sf)
    parsed = events.parse(raw, CLICKS, F.col("ingested_at"))
    return profile.profile_batches(
        parsed, CLICKS.name, CLICKS.expected_columns, shape=profile.shape_of("value"),
        also=("ingested_at", "source_topic"),
    )


@query
def schema_fingerprint(spark, sf):
    """Each batch's fingerprint with what it stands for: its keys, sorted and joined by commas."""
    keys = observed_keys(spark, sf).groupBy("batch_id").agg(
        F.array_join(F.sort_array(F.collect_list("key")), ",").alias("columns")
    )
    return _json_profiles(spark, sf).select(
        "batch_id", "record_count", "column_count", "schema_hash", "null_rate_avg",
    ).join(keys, "batch_id", "left")


@query
def observed_keys(spark, sf):
    """What the fingerprints stand for: the keys of each batch."""
    raw = fixture.click_json(spark, sf)
    return profile.observed_keys(raw, profile.shape_of("value"), ("ingested_at", "source_topic"))


@query
def schema_baseline(spark, sf):
    return profile.baselines(_json_profiles(spark, sf))


def _quarantine_json(spark, sf) -> DataFrame:
    return fixture.click_json(spark, sf).withColumnRenamed("value", "record_json")


@query
def incoming_keys(spark, sf):
    return drift.key_report(_quarantine_json(spark, sf), CLICKS.name)


@query
def new_columns(spark, sf):
    keys = drift.incoming_keys(_quarantine_json(spark, sf))
    return drift.new_columns(keys, CLICKS, existing=["extra_metadata"])


@query
def keys_catalogued(spark, sf):
    """Two rounds of healing, each over the quarantine loads since the one before."""
    warehouse = Warehouse(spark, new_folder(spark, "keys"))
    records = _quarantine_json(spark, sf).withColumn("reject_reason", F.lit("SCHEMA_DRIFT"))
    for i, more in enumerate(("event_id % 103 <> 0 AND event_id % 2 = 0", "event_id % 2 = 1 OR event_id % 103 = 0")):
        mine = records.filter(more).select(
            "topic", F.col("batch_id").cast("bigint").alias("batch_id"), "reject_reason", "record_json",
            F.col("ingested_at").alias("quarantine_ts"),
        )
        warehouse.write_load(mine, "quarantine_log", "round", i, F.lit("2024-01-31").cast("date"))
        jobs.heal_schema(warehouse, CLICKS, i, f"2024-02-0{i + 1} 00:00:00")
    return warehouse.read("payload_keys")


def _schema_change(spark, sf) -> DataFrame:
    keys = drift.incoming_keys(_quarantine_json(spark, sf))
    found = drift.new_columns(keys, CLICKS)
    return drift.schema_change_rows(found, CLICKS.raw_table, 7, "2024-01-20 08:00:00")


@query
def schema_changes_row(spark, sf):
    changes = _schema_change(spark, sf)
    return changes.withColumn("new_columns", F.array_join("new_columns", ","))


@query
def schema_changes(spark, sf):
    return reports.schema_changes(_schema_change(spark, sf), AS_OF)


# ------------------------------------------------------------------ marts


@query
def orders_daily(spark, sf):
    return marts.orders_daily(_stg_orders(spark, sf))


@query
def orders_daily_any_amount(spark, sf):
    """Days with amounts of any size: huge, tiny, NaN and infinite ones, through validation and staging."""
    odd = F.expr(
        "CASE ingest_seq % 101 WHEN 0 THEN double('NaN') WHEN 1 THEN double('Infinity') WHEN 2 THEN 1e30D "
        "WHEN 3 THEN 4e-13D ELSE amount END"
    )
    raw = fixture.orders_raw(spark, sf).withColumn("amount", odd)
    good = validate.good_rows(validate.with_reject_reason(raw, ORDERS.record_type))
    return marts.orders_daily(staging.stg_orders(good, [fixture.SEQUENCE]))


@query
def clicks_daily(spark, sf):
    return marts.clicks_daily(_stg_clicks(spark, sf))


@query
def inventory_daily(spark, sf):
    return marts.inventory_daily(_stg_inventory(spark, sf))


@query
def mart_stream_overview(spark, sf):
    return marts.mart_stream_overview(
        _stg_orders(spark, sf), _stg_clicks(spark, sf), _stg_inventory(spark, sf), AS_OF
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A frame that several models read, stored once as the jobs store it."""
    return written_to(df, new_folder(df.sparkSession, name))


def _health(spark, sf) -> DataFrame:
    stored = _stored(fixture.stream_profiles(spark, sf), "profiles")
    return marts.mart_pipeline_health(
        staging.stg_stream_profiles(stored),
        staging.stg_anomaly_log(fixture.anomaly_log(stored)),
        AS_OF,
    )


@query
def mart_pipeline_health(spark, sf):
    return _health(spark, sf)


@query
def mart_anomaly_summary(spark, sf):
    log = fixture.anomaly_log(fixture.stream_profiles(spark, sf))
    return marts.mart_anomaly_summary(staging.stg_anomaly_log(log), AS_OF)


# ------------------------------------------------------------------ reports


@query
def pipeline_status(spark, sf):
    return reports.pipeline_status(_health(spark, sf), "2024-01-15")


@query
def pipeline_history(spark, sf):
    return reports.pipeline_history(_health(spark, sf), "2024-01-31 10:00:00", days=7)


@query
def system_summary(spark, sf):
    return reports.system_summary(_health(spark, sf), "2000-03-12")


@query
def sla_report(spark, sf):
    return reports.sla_report(_health(spark, sf), "2000-03-13 06:00:00")


@query
def stream_overview(spark, sf):
    overview = mart_stream_overview(spark, sf)
    return reports.stream_overview(overview, "2001-11-04 00:00:00", days=7)


@query
def latest_profiles(spark, sf):
    return reports.latest_profiles(
        staging.stg_stream_profiles(fixture.stream_profiles(spark, sf)), limit=20
    )


@query
def recent_anomalies(spark, sf):
    log = fixture.anomaly_log(fixture.stream_profiles(spark, sf))
    return reports.recent_anomalies(
        log, "2024-01-31 00:00:00", hours=24 * 14, severity="high", topic="clickstream_topic",
        limit=100,
    )


@query
def unscored_profiles(spark, sf):
    stored = fixture.stream_profiles(spark, sf)
    return reports.unscored_profiles(
        stored, fixture.anomaly_log(stored), "2024-01-31 00:00:00", hours=24 * 30
    )


@query
def remediation_actions(spark, sf):
    return reports.remediation_actions(fixture.anomaly_log(fixture.stream_profiles(spark, sf)))


# ------------------------------------------------------------------ data quality


@query
def dq_unique(spark, sf):
    """Uniqueness before and after deduplication."""
    raw = fixture.orders_raw(spark, sf)
    clicks = fixture.clickstream_raw(spark, sf)
    return union(
        [
            quality.run_checks(raw, "orders_raw", [quality.unique("order_id")]),
            quality.run_checks(clicks, "clickstream_raw", [quality.unique("session_id")]),
            quality.run_checks(_stg_orders(spark, sf), "stg_orders", [quality.unique("order_id")]),
        ]
    )


@query
def dq_not_null(spark, sf):
    checks = [quality.not_null(c) for c in ORDERS.table_schema.names]
    return quality.run_checks(fixture.orders_raw(spark, sf), "orders_raw", checks)


@query
def dq_expression(spark, sf):
    orders = [quality.expression("amount", ">= 0"), quality.expression("quantity", "BETWEEN 5 AND 40")]
    inventory = [quality.expression("stock_level", ">= 0")]
    return union(
        [
            quality.run_checks(fixture.orders_raw(spark, sf), "orders_raw", orders),
            quality.run_checks(fixture.inventory_raw(spark, sf), "inventory_raw", inventory),
        ]
    )


@query
def dq_accepted_values(spark, sf):
    checks = [
        quality.accepted("currency", ["INR", "USD"]),
        quality.accepted("status", ["placed", "delivered", "returned"]),
    ]
    return quality.run_checks(fixture.orders_raw(spark, sf), "orders_raw", checks)


@query
def dq_report(spark, sf):
    """All declared checks over all models; what the marts read is stored first."""
    stored = _stored(fixture.stream_profiles(spark, sf), "profiles")
    stg_profiles = staging.stg_stream_profiles(stored)
    stg_anomalies = staging.stg_anomaly_log(fixture.anomaly_log(stored))
    orders, clicks, stock = (
        _stored(f(spark, sf), f.__name__.strip("_")) for f in (_stg_orders, _stg_clicks, _stg_inventory)
    )
    models = {
        "stg_orders": orders,
        "stg_clickstream": clicks,
        "stg_inventory": stock,
        "stg_stream_profiles": stg_profiles,
        "stg_anomaly_log": stg_anomalies,
        "mart_pipeline_health": marts.mart_pipeline_health(stg_profiles, stg_anomalies, AS_OF),
        "mart_stream_overview": marts.mart_stream_overview(orders, clicks, stock, AS_OF),
    }
    return union([quality.run_checks(df, name) for name, df in models.items()])


# ------------------------------------------------------------------ dead-letter repair


def _repaired(spark, sf, topic: Topic) -> DataFrame:
    return repair.repair(_letters(spark, sf, topic), topic)


@query
def dlq_repair_orders(spark, sf):
    return _repaired(spark, sf, ORDERS)


@query
def dlq_repair_clicks(spark, sf):
    return _repaired(spark, sf, CLICKS)


@query
def dlq_repair_inventory(spark, sf):
    return _repaired(spark, sf, INVENTORY)


@query
def dlq_outcomes(spark, sf):
    return union(
        [
            repair.outcome_counts(_repaired(spark, sf, t)).withColumn("topic", F.lit(t.name))
            for t in TOPICS.values()
        ]
    )


@query
def dlq_replay(spark, sf):
    """All repaired orders, as they are published again."""
    replay = repair.replayable(_repaired(spark, sf, ORDERS), "2024-02-01T00:00:00")
    return replay.drop("outcome")


# ------------------------------------------------------------------ anomaly model


def _features(spark, sf) -> DataFrame:
    return forest.feature_frame(fixture.stream_profiles(spark, sf), AS_OF, ALL_DAYS)


@query
def anomaly_features(spark, sf):
    return _features(spark, sf)


@query
def training_volume(spark, sf):
    return forest.training_volume(fixture.stream_profiles(spark, sf), AS_OF, days=30)


@query
def standardize_features(spark, sf):
    scaled = forest.standardize(_features(spark, sf))
    return scaled.select(
        "profile_id", "topic", "batch_id", *[fx.round_to(c, 4).alias(c) for c in forest.fv.FEATURES]
    )


def _model(spark, sf) -> tuple[DataFrame, forest.Model]:
    features = _stored(_features(spark, sf), "features")
    return features, forest.fit(features, AS_OF)


@query
def iforest_model(spark, sf):
    nodes = _model(spark, sf)[1].nodes_df(spark)
    return nodes.withColumn("threshold", F.nullif("threshold", F.lit(float("nan"))))


@query
def model_metadata(spark, sf):
    """The model's metadata, the statistics of each feature as columns."""
    meta = _model(spark, sf)[1].meta_df(spark)

    def stats(name: str, column: str) -> list:
        return [fx.round_to(F.col(column)[i], 4).alias(f"{name}_{c}") for i, c in enumerate(forest.fv.FEATURES)]

    return meta.select(
        "trained_at", "rows", "flagged", "contamination", F.array_join("feature_cols", ",").alias("features"),
        *[fx.round_to(c, 6).alias(c) for c in ("cutoff", "score_mean", "score_std", "threshold")],
        *stats("mean", "means"), *stats("std", "stds"),
    )


@query
def anomaly_scores(spark, sf):
    features, model = _model(spark, sf)
    return forest.score(features, model, AS_OF)


@query
def anomaly_alerts(spark, sf):
    return forest.alerts(anomaly_scores(spark, sf))


# ------------------------------------------------------------------ streaming


@query
def stream_orders_validated(spark, sf):
    """Orders sent through the stream as JSON files, as they land in the raw table."""
    return ingest.replay_as_stream(fixture.orders_raw(spark, sf), ORDERS).select(
        *ORDERS.payload.names, "source_topic"
    )


@query
def stream_latest_orders(spark, sf):
    """Keep-latest by keyed state: orders arrive in three batches, out of their order, with a restart
    after each; what came out for a key last is its latest row."""
    folder = new_folder(spark, "stream-latest")
    raw = written_to(fixture.orders_raw(spark, sf).filter("order_id IS NOT NULL"), f"{folder}/sent")
    for part in (2, 0, 1):
        raw.filter(F.pmod(F.col("ingest_seq"), F.lit(3)) == part).write.mode("append").parquet(f"{folder}/in")
        latest = latest_in_stream(
            spark.readStream.schema(raw.schema).parquet(f"{folder}/in"), ["order_id"], "ingested_at", "10000 days", "ingest_seq"
        )
        won = latest.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True)
        won.foreachBatch(lambda df, i, part=part: df.withColumn("load", F.lit(f"{part} {i}")).write.mode("append").parquet(f"{folder}/won")).start().awaitTermination()
    folders.remove(spark, f"{folder}/sent")
    every = spark.read.parquet(f"{folder}/won").drop("load")
    return latest_per_key(every, ["order_id"], "ingested_at", ["ingest_seq"])


@query
def latest_orders(spark, sf):
    """Keep-latest alone, over all columns of the raw stream."""
    raw = fixture.orders_raw(spark, sf).filter("order_id IS NOT NULL")
    return latest_per_key(raw, ["order_id"], "ingested_at", ["ingest_seq"])
