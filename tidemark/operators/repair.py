"""Dead-letter repair: fill defaults, mend rule violations, re-validate, replay once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.operators.drift import as_map, healed_values
from tidemark.operators.validate import reject_reason
from tidemark.topics import Topic

REPROCESSED, UNFIXABLE, SKIPPED, ERROR = "reprocessed", "unfixable", "skipped", "error"


def repair(
    letters: DataFrame,
    topic: Topic,
    extra_columns: tuple[str, ...] = (),
    healed: tuple[str, ...] = (),
) -> DataFrame:
    """Repair one topic's envelopes.

    Returns the payload columns after repair, the `healed` columns that were added to the topic,
    the envelope's batch_id and reason, any `extra_columns` of the envelope, and `outcome`:

    * reprocessed - repaired and valid now
    * unfixable   - still invalid after repair
    * skipped     - a reason that has no repair
    * error       - the record is no JSON object
    """
    mine = letters.filter(F.col("source") == topic.record_type)
    parsed = mine.select(
        "batch_id",
        "reason",
        *extra_columns,
        F.json_object_keys("record").isNotNull().alias("_readable"),
        F.from_json("record", topic.payload).alias("_p"),
        *[as_map("record").alias("_pairs")][: len(healed)],
    )
    # Parsing by the payload schema also strips the internal keys of the envelope.
    fixed = parsed.select(
        "batch_id",
        "reason",
        *extra_columns,
        "_readable",
        *[_mended(topic, name, dtype).alias(name) for name, dtype in _fields(topic)],
        *healed_values("_pairs", healed),
    )
    known = F.col("reason").isin(fv.NULL_REQUIRED_FIELD, fv.BUSINESS_RULE_VIOLATION)
    still_bad = reject_reason(topic.record_type, topic.payload.names).isNotNull()
    outcome = (
        F.when(~F.col("_readable"), ERROR)
        .when(~F.coalesce(known, F.lit(False)), SKIPPED)
        .when(still_bad, UNFIXABLE)
        .otherwise(REPROCESSED)
    )
    return fixed.withColumn("outcome", outcome).drop("_readable")


def replayable(repaired: DataFrame, stamped_at: str) -> DataFrame:
    """All repaired rows to publish, stamped with time and old reason."""
    ready = repaired.filter(F.col("outcome") == REPROCESSED)
    return ready.withColumn("_reprocessed_at", F.lit(stamped_at)).withColumn(
        "_original_reason", F.col("reason")
    )


def outcome_counts(repaired: DataFrame) -> DataFrame:
    return repaired.groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


def as_events(replay: DataFrame, topic: Topic, healed: tuple[str, ...] = ()) -> DataFrame:
    """Replay rows as the JSON text the topic carries."""
    fields = [*topic.payload.names, *healed, "_reprocessed_at", "_original_reason"]
    return replay.select(F.to_json(F.struct(*fields)).alias("value"))


def _fields(topic: Topic) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in topic.payload.fields]


def _mended(topic: Topic, name: str, dtype: str) -> Column:
    value = F.col(f"_p.{name}")
    mended = F.when(F.lit(False), value)
    if name in topic.null_defaults:
        filled = F.coalesce(value, F.lit(topic.null_defaults[name]).cast(dtype))
        mended = mended.when(F.col("reason") == fv.NULL_REQUIRED_FIELD, filled)
    if name in topic.rule_repairs:
        repaired = topic.rule_repairs[name](value)
        mended = mended.when(F.col("reason") == fv.BUSINESS_RULE_VIOLATION, repaired)
    return mended.otherwise(value)
