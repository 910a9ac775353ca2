"""Record validation: one reason column per row, computed in a single narrow pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.scalars import as_of_ts
from tidemark.topics import BY_RECORD_TYPE


def reject_reason(record_type: str, columns: list[str]) -> Column:
    """Why a row is rejected, or NULL for a good row.

    Required fields that the frame does not have are not tested, and an unknown record type
    has no rules at all.
    """
    topic = BY_RECORD_TYPE.get(record_type)
    if topic is None:
        return F.lit(None).cast("string")
    absent = reduce(
        Column.__or__,
        [F.col(c).isNull() for c in topic.required if c in columns],
        F.lit(False),
    )
    reason = F.when(absent, fv.NULL_REQUIRED_FIELD)
    if topic.rule:
        meets_rule = F.coalesce(F.expr(topic.rule), F.lit(False))
        reason = reason.when(~meets_rule, fv.BUSINESS_RULE_VIOLATION)
    return reason


def with_reject_reason(df: DataFrame, record_type: str) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(record_type, df.columns))


def good_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col("reject_reason").isNotNull())


def validate_and_route(
    df: DataFrame, record_type: str, batch_id: int | Column, quarantine_ts: str | Column
) -> tuple[DataFrame, DataFrame]:
    """Split into (good, rejected); rejected rows carry reject_reason, batch_id, quarantine_ts.

    Both frames derive from the same annotated plan, so a caller that uses both should persist
    `df` first. No shuffle happens and equal rejects are all kept.
    """
    annotated = with_reject_reason(df, record_type)
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    stamp = quarantine_ts if isinstance(quarantine_ts, Column) else as_of_ts(quarantine_ts)
    rejected = (
        rejected_rows(annotated)
        .withColumn("batch_id", batch.cast("bigint"))
        .withColumn("quarantine_ts", stamp.cast("timestamp_ntz"))
    )
    return good_rows(annotated), rejected


def rule_rejects_distinct(df: DataFrame, record_type: str) -> DataFrame:
    """Distinct rule violations: the set difference of candidates and good rows.

    Rows equal in all columns get the same verdict, so the difference is a filter and a
    distinct. That aggregates before it shuffles, where EXCEPT would also join.
    """
    annotated = with_reject_reason(df, record_type)
    return annotated.filter(F.col("reject_reason") == fv.BUSINESS_RULE_VIOLATION).distinct()


def merge_rejects(null_rejects: DataFrame, rule_rejects: DataFrame) -> DataFrame:
    """Both kinds of rejects in one frame; a column missing on one side is NULL there."""
    return null_rejects.unionByName(rule_rejects, allowMissingColumns=True)


def routing_counts(annotated: DataFrame, *by: str) -> DataFrame:
    """Rows per (by..., outcome), where the outcome is GOOD or the reject reason."""
    outcome = F.coalesce("reject_reason", F.lit("GOOD")).alias("outcome")
    return annotated.groupBy(*by, outcome).agg(F.count(F.lit(1)).alias("records"))


def dead_letters(rejected: DataFrame, record_type: str) -> DataFrame:
    """Reject envelope: source, batch_id, reason and the record as JSON text.

    Columns whose name starts with an underscore are internal and stay out of the record, as
    does the raw text. The time of rejection is kept beside it.
    """
    fields = [c for c in rejected.columns if not c.startswith("_") and c != "value"]
    return rejected.select(
        F.lit(record_type).alias("source"),
        F.col("batch_id").cast("bigint").alias("batch_id"),
        F.coalesce("reject_reason", F.lit("UNKNOWN")).alias("reason"),
        F.to_json(F.struct(*fields)).alias("record"),
        "quarantine_ts",
    )


def retained(quarantine: DataFrame, as_of: str, days: int = fv.QUARANTINE_DAYS) -> DataFrame:
    """Quarantined rows younger than the retention period."""
    return quarantine.filter(F.col("quarantine_ts") >= _retention_start(as_of, days))


def expired(quarantine: DataFrame, as_of: str, days: int = fv.QUARANTINE_DAYS) -> DataFrame:
    return quarantine.filter(F.col("quarantine_ts") < _retention_start(as_of, days))


def _retention_start(as_of: str, days: int) -> Column:
    return as_of_ts(as_of) - F.make_dt_interval(F.lit(days))
