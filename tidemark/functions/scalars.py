"""Scalar column expressions shared by the models. All stay inside generated JVM code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fv


def text_to_ts(c: Column | str) -> Column:
    """Text to timestamp, NULL when the text is no timestamp."""
    return _col(c).try_cast("timestamp_ntz")


def day_of(ts: Column | str) -> Column:
    # Through DATE rather than date_trunc: date_trunc goes through the session time zone.
    return _col(ts).cast("date").cast("timestamp_ntz")


def hour_start_of(ts: Column | str) -> Column:
    return day_of(ts) + F.make_dt_interval(F.lit(0), F.hour(_col(ts)))


def weekday_of(ts: Column | str) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(_col(ts)) - 1


def as_of_ts(as_of: str | datetime) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def round_to(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a double's decimal digits; NaN and infinities pass unchanged."""
    return F.round(_col(c).cast("double"), digits)


def band_below(c: Column | str, limits: dict, otherwise: str) -> Column:
    """Label of the first limit that the value lies strictly below; limits in rising order."""
    c, out = _col(c), None
    for label, limit in limits.items():
        test = c < F.lit(limit)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(otherwise)


def severity_of(score: Column | str) -> Column:
    return band_below(score, fv.SEVERITY_BELOW, "NORMAL")


def severity_rank(severity: Column | str) -> Column:
    c, out = _col(severity), None
    for label, rank in fv.SEVERITY_RANK.items():
        out = F.when(c == label, rank) if out is None else out.when(c == label, rank)
    return out.otherwise(1)


def stock_status(stock: Column | str) -> Column:
    return band_below(stock, fv.STOCK_BELOW, "HEALTHY")


def is_conversion(action: Column | str) -> Column:
    return F.coalesce(_col(action).isin(*fv.CONVERSION_ACTIONS), F.lit(False))


def sla_band(sla_pct: Column | str) -> Column:
    sla = F.coalesce(_col(sla_pct), F.lit(0.0))
    return F.when(sla >= fv.SLA_GREEN, "green").when(sla >= fv.SLA_AMBER, "amber").otherwise("red")


def is_drifted(schema_hash: Column | str, expected_hash: Column | str) -> Column:
    """True when the fingerprint differs from a known baseline; no baseline means no drift."""
    got = _col(schema_hash)
    return got != F.coalesce(_col(expected_hash), got)


def stable_id(*parts: Column | str) -> Column:
    """Positive 60-bit id computed from the values, equal on every run and engine."""
    text = F.concat_ws("#", *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
