"""Data-quality checks. All checks over one table run in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv


class QualityError(RuntimeError):
    """Raised by the gate; `failures` lists (table, check, column, count)."""

    def __init__(self, failures: list[tuple]):
        super().__init__("; ".join(f"{t}.{c} {k}: {n}" for t, k, c, n in failures))
        self.failures = failures


@dataclass(frozen=True)
class Check:
    kind: str  # unique | not_null | expression | accepted_values
    column: str
    expression: str | None = None
    accepted: tuple[str, ...] = ()

    def violation(self) -> Column:
        """Row test for every kind but `unique`; a NULL value only violates not_null."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "expression":
            return ~F.expr(self.expression)
        if self.kind == "accepted_values":
            return ~F.col(self.column).isin(*self.accepted)
        raise ValueError(self.kind)


def unique(column: str) -> Check:
    return Check("unique", column)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def expression(column: str, condition: str) -> Check:
    return Check("expression", column, f"{column} {condition}")


def accepted(column: str, values: Sequence[str]) -> Check:
    return Check("accepted_values", column, accepted=tuple(values))


# The declared checks per table
CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_orders": (
        unique("order_id"), not_null("order_id"), not_null("customer_id"), not_null("amount"),
        expression("amount", ">= 0"), accepted("status", fv.ORDER_STATUSES), not_null("region"),
    ),
    "stg_clickstream": (
        unique("session_id"), not_null("session_id"), not_null("user_id"),
        expression("duration_ms", ">= 0"),
    ),
    "stg_inventory": (
        not_null("sku"), not_null("stock_level"), expression("stock_level", ">= 0"),
    ),
    "stg_stream_profiles": (
        unique("profile_id"), not_null("profile_id"), expression("record_count", ">= 0"),
    ),
    "stg_anomaly_log": (
        unique("anomaly_id"), not_null("anomaly_id"), accepted("severity", fv.SEVERITIES),
    ),
    "mart_pipeline_health": (expression("pipeline_sla_pct", "BETWEEN 0 AND 100"),),
    "mart_stream_overview": (expression("total_orders", ">= 0"),),
}


def run_checks(df: DataFrame, table: str, checks: Sequence[Check] | None = None) -> DataFrame:
    """Rows (table_name, check_kind, column_name, violations, passed), one per check.

    Row checks are counted in one aggregation. Where a table also has a unique key, the rows
    are first reduced per key, so the same single shuffle answers both; a key shared by many
    rows is combined before it travels. A second unique key needs a pass of its own.
    """
    checks = list(CHECKS[table] if checks is None else checks)
    keys = [c for c in checks if c.kind == "unique"]
    report = _one_pass(df, table, [c for c in checks if c not in keys[1:]])
    for key in keys[1:]:
        report = report.unionByName(_one_pass(df, table, [key]))
    return report


def _one_pass(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    names = [f"_v{i}" for i in range(len(checks))]
    counted = [
        F.count_if(c.violation()).alias(v) for c, v in zip(checks, names) if c.kind != "unique"
    ]
    key = next((c.column for c in checks if c.kind == "unique"), None)
    if key is None:
        total = df.agg(*counted)
    else:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), *counted)
        shared = F.count_if(F.col(key).isNotNull() & (F.col("_copies") > 1))
        total = per_key.agg(
            *[
                (shared if c.kind == "unique" else F.coalesce(F.sum(v), F.lit(0))).alias(v)
                for c, v in zip(checks, names)
            ]
        )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c.kind).alias("check_kind"),
            F.lit(c.column).alias("column_name"),
            F.col(v).cast("bigint").alias("violations"),
        )
        for c, v in zip(checks, names)
    ]
    return total.select(F.inline(F.array(*rows))).withColumn("passed", F.col("violations") == 0)


def require_passed(results: DataFrame) -> None:
    """Raise when any check failed. `results` has one row per declared check."""
    bad = results.filter(~F.col("passed")).orderBy("table_name", "check_kind", "column_name")
    failures = [
        (r["table_name"], r["check_kind"], r["column_name"], r["violations"])
        for r in bad.collect()
    ]
    if failures:
        raise QualityError(failures)
