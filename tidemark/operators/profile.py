"""Micro-batch profiles: counts, null rates and schema fingerprints in one aggregation."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.scalars import round_to, stable_id


def key_hash(key: Column) -> Column:
    """A name as a whole number below 2^60."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def fingerprint(names: Column, hashes: Column) -> Column:
    """Digest of a set of names by how many they are and the sum of their hashes.

    Sums need no order and no place where all names meet, so a set may be of any size.
    """
    total = F.coalesce(hashes, F.lit(0)).cast("decimal(38,0)").cast("string")
    return F.sha2(F.concat_ws(":", names.cast("string"), total).cast("binary"), 256)


def shape_of(value: Column | str) -> Column:
    """The keys of a JSON object text, as text; no keys when malformed.

    Text rather than an array: a batch has few shapes, which compress and group well as text.
    """
    c = F.col(value) if isinstance(value, str) else value
    return shape_text(F.json_object_keys(c))


def shape_text(keys: Column) -> Column:
    return F.coalesce(F.to_json(keys), F.lit("[]"))


def _keys_of(shape: Column, also: Sequence[str]) -> Column:
    """Sorted keys of a shape plus the given names. Internal keys do not count."""
    keys = F.array_except(F.from_json(shape, "array<string>"), _names(fv.INTERNAL_KEYS))
    return F.array_union(keys, _names(also))


def _names(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def profile_batches(
    df: DataFrame,
    topic: str,
    columns: Sequence[str],
    batch: Column | str = "batch_id",
    ingested_at: str = "ingested_at",
    shape: Column | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """One profile row per batch.

    `columns` are the columns whose null rates count. `shape` holds the row's observed keys
    (see `shape_of`), to which the names in `also` are added; without it, `columns` are the
    observed names of every row. Rows are first reduced per (batch, shape), then per (batch, key)
    and then per batch, so a hot batch does not travel row by row, and no set of keys is gathered,
    however many a batch has.
    """
    batch = F.col(batch) if isinstance(batch, str) else batch
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)]
    base = df.withColumn("_batch", batch.cast("bigint"))
    count = F.count(F.lit(1)).alias("record_count")
    first = F.min(ingested_at).alias("_first")
    if shape is None:
        names = sorted(set(columns))
        hashes = sum(int(hashlib.md5(n.encode()).hexdigest()[:15], 16) for n in names)
        totals = base.groupBy("_batch").agg(count, first, *nulls).select(
            "*", F.lit(len(names)).alias("_names"), F.lit(str(hashes)).cast("decimal(38,0)").alias("_hashes")
        )
    else:
        per_shape = base.groupBy("_batch", shape.alias("_shape")).agg(count, first, *nulls)
        # One row per (shape, key); a shape's counts are taken from its first key only.
        spread = F.posexplode_outer(_keys_of(F.col("_shape"), also)).alias("_pos", "_key")
        once = F.coalesce("_pos", F.lit(0)) == 0
        counted = ["record_count", *[f"_n{i}" for i in range(len(columns))]]
        per_key = per_shape.select("*", spread).groupBy("_batch", "_key").agg(
            F.min("_first").alias("_first"),
            *[F.coalesce(F.sum(F.when(once, F.col(c))), F.lit(0)).alias(c) for c in counted],
        )
        totals = per_key.groupBy("_batch").agg(
            F.min("_first").alias("_first"),
            *[F.sum(c).alias(c) for c in counted],
            F.count("_key").alias("_names"),
            F.sum(key_hash(F.col("_key")).cast("decimal(20,0)")).alias("_hashes"),
        )

    rates = [f"_r{i}" for i in range(len(columns))]
    rated = totals.select(
        "*",
        *[
            round_to(F.col(f"_n{i}") / F.col("record_count"), 6).alias(rates[i])
            for i in range(len(columns))
        ],
    )
    mean_rate = reduce(Column.__add__, map(F.col, rates)) / F.lit(float(len(rates)))
    max_rate = F.greatest(*rates) if len(rates) > 1 else F.col(rates[0])
    names = F.array(*[F.lit(c) for c in columns])
    return rated.select(
        stable_id(F.lit(topic), F.col("_batch")).alias("profile_id"),
        F.lit(topic).alias("topic"),
        F.col("_batch").alias("batch_id"),
        "record_count",
        round_to(mean_rate, 6).alias("null_rate_avg"),
        round_to(max_rate, 6).alias("null_rate_max"),
        fingerprint(F.col("_names"), F.col("_hashes")).alias("schema_hash"),
        F.col("_names").cast("int").alias("column_count"),
        F.map_from_arrays(names, F.array(*rates)).alias("null_rates"),
        F.col("_first").cast("string").alias("profile_ts"),
        F.col("_first").alias("created_at"),
    )


def observed_keys(
    df: DataFrame, shape: Column, also: Sequence[str] = (), batch: Column | str = "batch_id"
) -> DataFrame:
    """The different keys of each batch, one row per (batch_id, key)."""
    batch = F.col(batch) if isinstance(batch, str) else batch
    shapes = df.select(batch.cast("bigint").alias("batch_id"), shape.alias("_shape")).distinct()
    return shapes.select("batch_id", F.explode(_keys_of(F.col("_shape"), also)).alias("key")).distinct()


def baselines(profiles: DataFrame) -> DataFrame:
    """The fingerprint of each topic's first batch."""
    return profiles.groupBy("topic").agg(
        F.min("batch_id").alias("baseline_batch_id"),
        F.min_by("schema_hash", "batch_id").alias("baseline_hash"),
    )


def with_baseline(profiles: DataFrame, known: DataFrame) -> DataFrame:
    """Add expected_schema_hash from a (topic, baseline_hash) table, NULL for a new topic."""
    expected = known.select("topic", F.col("baseline_hash").alias("expected_schema_hash"))
    return profiles.join(expected, "topic", "left")


def as_stored(profiles: DataFrame) -> DataFrame:
    """Profiles in the layout of the stored table."""
    return profiles.select(
        "profile_id", "topic", "batch_id", "record_count", "null_rate_avg", "null_rate_max",
        "schema_hash", "column_count", "expected_schema_hash",
        F.to_json("null_rates").alias("null_rates_json"), "profile_ts", "created_at",
    )


def null_rates_long(profiles: DataFrame) -> DataFrame:
    """One row per (profile, column)."""
    return profiles.select(
        "topic", "batch_id", F.explode("null_rates").alias("column_name", "null_rate")
    )
