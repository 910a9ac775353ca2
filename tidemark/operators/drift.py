"""Additive schema drift: find new payload keys and turn them into columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.scalars import as_of_ts
from tidemark.topics import Topic

SAFE_NAME = "^[A-Za-z0-9_]*[A-Za-z0-9][A-Za-z0-9_]*$"  # fixed value: letters, digits, underscore


def incoming_keys(records: DataFrame, json_column: str = "record_json") -> DataFrame:
    """Distinct (topic, key) over JSON records.

    Records are reduced to distinct key sets before the keys are spread to rows, so the
    explode runs over the few record shapes and not over the records.
    """
    shape = F.array_sort(F.json_object_keys(json_column)).alias("shape")
    shapes = records.select("topic", shape).distinct()
    return shapes.select("topic", F.explode("shape").alias("key")).distinct()


def key_report(records: DataFrame, topic: str) -> DataFrame:
    """All keys of one topic in name order."""
    keys = incoming_keys(records.filter(F.col("topic") == topic))
    return keys.orderBy("key")


def known_names(topic: Topic, existing: Iterable[str] = ()) -> list[str]:
    return [*topic.expected_columns, *existing, *fv.INTERNAL_KEYS]


def new_columns(keys: DataFrame, topic: Topic, existing: Iterable[str] = ()) -> DataFrame:
    """Keys of the topic that are in neither the contract nor the table, with a safety flag.

    Names are compared in lower case; internal keys are never new.
    """
    known = sorted({c.lower() for c in known_names(topic, existing)})
    names = (
        keys.filter(F.col("topic") == topic.name)
        .select("topic", F.lower("key").alias("column_name"))
        .distinct()
    )
    return names.filter(~F.col("column_name").isin(known)).withColumn(
        "is_safe", F.col("column_name").rlike(SAFE_NAME)
    )


def schema_change_rows(
    found: DataFrame, table_name: str, batch_id: int, detected_at: str
) -> DataFrame:
    """One audit row per topic that gained at least one safe column."""
    return (
        found.filter("is_safe")
        .groupBy("topic")
        .agg(F.sort_array(F.collect_set("column_name")).alias("new_columns"))
        .select(
            "topic",
            F.lit(table_name).alias("table_name"),
            "new_columns",
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(detected_at).alias("detected_at"),
            as_of_ts(detected_at).alias("created_at"),
        )
    )


def healed_columns(changes: DataFrame, topic: Topic) -> list[str]:
    """Columns added to a topic so far. As bounded as the width of its table."""
    names = (
        changes.filter(F.col("topic") == topic.name)
        .select(F.explode("new_columns").alias("name"))
        .distinct()
    )
    return sorted(r["name"] for r in names.collect())


def healed_values(value: Column | str, names: Iterable[str]) -> list[Column]:
    """String columns of healed names, matched without case, from the record's map.

    `value` is the map that `as_map` gives. Of keys that differ in case only, all values are
    kept, as the text of a JSON array in the order of the record.
    """
    c = F.col(value) if isinstance(value, str) else value

    def found(name: str) -> Column:
        values = F.map_values(F.map_filter(c, lambda key, _: F.lower(key) == name))
        return F.when(F.size(values) > 1, F.to_json(values)).otherwise(F.get(values, F.lit(0)))

    return [found(n).alias(n) for n in names]


def as_map(json: Column | str) -> Column:
    """A JSON object's keys and values as text."""
    return F.from_json(json, "map<string,string>")
