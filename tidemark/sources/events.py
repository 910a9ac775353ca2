"""Event sources: Kafka topics or text files, both through the same parser."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.operators.drift import as_map, healed_values
from tidemark.topics import Topic


def kafka_options(
    topic: Topic,
    servers: str,
    per_trigger: int | None = None,
    starting: str = fv.STARTING_OFFSETS,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Reader options. Without `per_trigger` a micro-batch takes all that has arrived, so that a
    backlog cannot outlive the topic's retention; lost offsets stop the stream unless allowed."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic.name,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_stream(spark: SparkSession, topic: Topic, servers: str, **options) -> DataFrame:
    """Raw values of a topic. Needs the Kafka connector on the class path."""
    source = spark.readStream.format("kafka").options(**kafka_options(topic, servers, **options)).load()
    return source.select(F.col("value").cast("string").alias("value"))


def for_kafka(rows: DataFrame, topic_name: str, servers: str, value: str = "value", key: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Rows as the (key, value) that the Kafka writer takes, and its options."""
    keyed = F.lit(None) if key is None else F.col(key)
    message = rows.select(keyed.cast("string").alias("key"), F.col(value).cast("string").alias("value"))
    return message, {"kafka.bootstrap.servers": servers, "topic": topic_name}


def publish(rows: DataFrame, topic_name: str, servers: str, value: str = "value", key: str | None = None) -> None:
    """Send rejects or repaired records to a topic. Needs the Kafka connector."""
    message, options = for_kafka(rows, topic_name, servers, value, key)
    message.write.format("kafka").options(**options).save()


def text_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Raw values from text files with one JSON object per line. A micro-batch takes at most so many
    files or, as they are stored, bytes, but one file at least."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(path)


def parse(
    raw: DataFrame,
    topic: Topic,
    ingested_at: Column | None = None,
    healed: Sequence[str] = (),
    value: str = "value",
) -> DataFrame:
    """Payload and metadata columns next to the raw text.

    Malformed text gives NULL fields, as does a field of the wrong type. `healed` names
    string columns that were added to the topic later. In a stream the default time is the
    batch's own, which stays the same when a batch is run again.
    """
    now = F.current_timestamp() if ingested_at is None else ingested_at
    kept = [c for c in raw.columns if c not in topic.expected_columns]
    stamped = raw.select(
        *kept,
        *[as_map(value).alias("_pairs")][: len(healed)],
        F.from_json(value, topic.payload).alias("_event"),
        now.cast("timestamp_ntz").alias("ingested_at"),
        F.lit(topic.name).alias("source_topic"),
    )
    metadata = {"ingest_date": F.to_date("ingested_at")}
    return stamped.select(
        *kept,
        *[F.col(f"_event.{name}").alias(name) for name in topic.payload.names],
        *healed_values("_pairs", healed),
        *[
            metadata.get(name, F.col(name)).alias(name)
            for name in topic.expected_columns
            if name not in topic.payload.names
        ],
    )
