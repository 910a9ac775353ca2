"""Structured Streaming ingest: parse, validate, store, profile - one function for all topics."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tidemark import fixed_values as fv
from tidemark.operators import drift, profile, validate
from tidemark.session import new_folder
from tidemark.sources import events
from tidemark.sources.tables import Warehouse
from tidemark.topics import Topic

SCHEMA_DRIFT = "SCHEMA_DRIFT"


def process_batch(
    batch: DataFrame,
    batch_id: int,
    topic: Topic,
    warehouse: Warehouse,
    source: str,
    healed: tuple[str, ...] = (),
    after: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Validate a micro-batch, store good rows, rejects and the profile.

    The batch is parsed once and kept while its outputs are written; its raw text is kept only
    where it goes to the quarantine. Each output goes to a folder named by (source, batch id), and
    all times come from the batch itself, so running a batch again after a failure replaces what it
    wrote before.
    """
    known = [c.lower() for c in drift.known_names(topic, healed)]
    unknown = F.exists("_keys", lambda key: ~F.lower(key).isin(known))
    batch = (
        batch.withColumn("_keys", F.json_object_keys("value"))
        .withColumn("_shape", profile.shape_text(F.col("_keys")))
        .withColumn("_drifted", F.coalesce(unknown, F.lit(False)))
        .drop("_keys")
    )
    annotated = validate.with_reject_reason(batch, topic.record_type)
    annotated = annotated.withColumn(
        "value", F.when(F.col("reject_reason").isNotNull() | F.col("_drifted"), F.col("value"))
    )
    batch = annotated.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if batch.isEmpty():
            return
        columns = [*topic.expected_columns, *healed]
        good = validate.good_rows(batch).select(*columns)
        warehouse.write_load(good, topic.raw_table, source, batch_id, "ingested_at", healed)

        rejected = validate.rejected_rows(batch).select(
            "*", F.lit(batch_id).alias("batch_id"), F.col("ingested_at").alias("quarantine_ts")
        )
        letters = validate.dead_letters(rejected, topic.record_type)
        warehouse.write_load(letters, "dead_letters", source, batch_id, "quarantine_ts")

        quarantined = _quarantined(batch, topic, batch_id)
        warehouse.write_load(quarantined, "quarantine_log", source, batch_id, "quarantine_ts")

        metadata = [c for c in topic.expected_columns if c not in topic.payload.names]
        found = profile.profile_batches(
            batch, topic.name, columns, F.lit(batch_id), shape=F.col("_shape"), also=metadata
        )
        _store_profile(found, batch_id, topic, warehouse, source)
        if after is not None:
            after(good, batch_id)
    finally:
        batch.unpersist()


def _quarantined(annotated: DataFrame, topic: Topic, batch_id: int) -> DataFrame:
    """Raw text of rejects and of good records with unknown keys, which healing reads."""
    reason = F.coalesce("reject_reason", F.when(F.col("_drifted"), SCHEMA_DRIFT))
    return annotated.select(
        F.lit(topic.name).alias("topic"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        reason.alias("reject_reason"),
        F.col("value").alias("record_json"),
        F.col("ingested_at").alias("quarantine_ts"),
    ).filter(F.col("reject_reason").isNotNull())


def _store_profile(
    found: DataFrame, batch_id: int, topic: Topic, warehouse: Warehouse, source: str
) -> None:
    """Store the profile; the first profile of a topic also becomes its baseline."""

    def baseline() -> str | None:
        row = warehouse.read("schema_baselines").filter(F.col("topic") == topic.name).first()
        return None if row is None else row["baseline_hash"]

    expected = baseline()
    if expected is None:
        one_place = F.lit("1970-01-01").cast("date")
        warehouse.write_load(profile.baselines(found), "schema_baselines", topic.name, 0, one_place)
        expected = baseline()
    stored = profile.as_stored(found.withColumn("expected_schema_hash", F.lit(expected)))
    warehouse.write_load(stored, "stream_profiles", source, batch_id, "created_at")


def start(
    raw: DataFrame,
    topic: Topic,
    warehouse: Warehouse,
    checkpoint: str,
    source: str | None = None,
    available_now: bool = False,
    trigger_interval: str = fv.TRIGGER_INTERVAL,
    after: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start ingest of a stream of raw JSON values; `checkpoint` names its progress folder.

    Columns healed before the start are parsed and stored as strings.
    """
    healed = tuple(warehouse.added_columns(topic.raw_table))
    handler = partial(
        process_batch,
        topic=topic,
        warehouse=warehouse,
        source=source or topic.name,
        healed=healed,
        after=after,
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": trigger_interval}
    return (
        events.parse(raw, topic, healed=healed)
        .writeStream.queryName(f"ingest_{source or topic.name}")
        .foreachBatch(lambda df, batch_id: handler(df, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def replay_as_stream(rows: DataFrame, topic: Topic, batch_bytes: int = fv.REPLAY_BATCH_BYTES) -> DataFrame:
    """Send rows through the topic's stream by way of JSON files; returns the raw table.

    The files are compressed, and a micro-batch takes so many bytes of them, so that what it keeps
    while its outputs are written does not grow with the rows sent.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, f"stream-{topic.raw_table}")
    values = rows.select(F.to_json(F.struct(*topic.payload.names)).alias("value"))
    values.write.option("compression", "gzip").text(f"{folder}/events")
    warehouse = Warehouse(spark, f"{folder}/tables")
    stream = start(
        events.text_stream(spark, f"{folder}/events", bytes_per_trigger=batch_bytes), topic, warehouse, f"{folder}/progress",
        available_now=True,
    )
    stream.awaitTermination()
    return warehouse.read(topic.raw_table)
