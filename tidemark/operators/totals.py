"""Totals per key in one pass: counts, distinct counts, extremes and exact sums of any doubles.

Doubles are summed by the decimal digits they are written with, and the sum is rounded to a double
once, so neither the order of rows nor their partitions show. Values of common size are summed as
one decimal. The others - very large or small, or with many digits - go to an accumulator per key
and decimal exponent band, whose sums are integers of a fixed unit; a key has at most as many bands
as doubles have exponents, and they are put together at the end. NaN and infinities are counted
apart and give what adding doubles gives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: common values have at most so many digits behind the point, and are below this size
_DIGITS, _BELOW = 12, 1e13
#: decimal exponents that one band spans
_BAND = 4
_NAN, _PLUS, _MINUS = 1000, 1001, 1002
_FIRST = {"count": F.count_if, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def totals(
    df: DataFrame,
    keys: dict[str, Column],
    sums: dict[str, Column] | None = None,
    distinct: tuple[str, Column] | None = None,
    **plain: tuple[str, Column],
) -> DataFrame:
    """One row per key, null keys included.

    For each of `sums`, its exact sum and, as `<name>_count`, how many values are not null; the sum
    of none is null. For `distinct`, a (name, column), the number of different values that are not
    null. `plain` names a ("count", condition), or the ("sum" | "min" | "max", column), of all rows.

    Rows meet twice: by key, value to count and band, combined before they travel, then by key.
    """
    sums = sums or {}
    names = list(sums)
    values = df.select(
        *[k.alias(n) for n, k in keys.items()],
        (F.lit(None) if distinct is None else distinct[1]).alias("_id"),
        *[c.alias(f"_in_{n}") for n, (_, c) in plain.items()],
        *[c.cast("double").alias(f"_v{i}") for i, c in enumerate(sums.values())],
    )
    common = [_common(F.col(f"_v{i}")) for i in range(len(names))]
    fits = values.select("*", *[c.alias(f"_c{i}") for i, c in enumerate(common)])
    odd = [
        F.when(F.col(f"_v{i}").isNotNull() & F.col(f"_c{i}").isNull(), F.struct(F.lit(i).alias("of"), F.col(f"_v{i}").alias("value")))
        for i in range(len(names))
    ]
    # one fact for the row itself, and one for each value that is not of common size
    facts = F.array(F.lit(None).cast("struct<of:int,value:double>"), *odd) if odd else None
    whole = fits.withColumn("_odd", F.lit(None).cast("struct<of:int,value:double>"))
    if odd:
        kept = F.filter(facts, lambda x, i: (i == 0) | x.isNotNull())
        whole = fits.withColumn("_odd", F.explode(kept))
    row = F.col("_odd").isNull()
    band, unit = _banded(F.col("_odd.value"))
    first = whole.groupBy(*keys, F.when(row, F.col("_id")).alias("_id"), F.col("_odd.of").alias("_of"), band.alias("_band")).agg(
        F.count(F.when(row, 1)).alias("_rows"),
        *[_FIRST[kind](F.when(row, F.col(f"_in_{n}"))).alias(f"_in_{n}") for n, (kind, _) in plain.items()],
        *[F.sum(F.when(row, F.col(f"_c{i}"))).alias(f"_c{i}") for i in range(len(names))],
        *[F.count(F.when(row, F.col(f"_v{i}"))).alias(f"_n{i}") for i in range(len(names))],
        F.sum(unit).alias("_unit"),
    )
    bands = F.collect_list(F.when(F.col("_of").isNotNull(), F.struct("_of", "_band", "_unit")))
    merged = first.groupBy(*keys).agg(
        *([] if distinct is None else [F.count(F.when(F.col("_of").isNull(), F.col("_id"))).alias(distinct[0])]),
        *[_MERGE[kind](f"_in_{n}").alias(n) for n, (kind, _) in plain.items()],
        *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(names))],
        *[F.sum(f"_n{i}").alias(f"{n}_count") for i, n in enumerate(names)],
        *([bands.alias("_bands")] if names else []),
    )
    counts = [f"{n}_count" for n in names]
    return _together(merged, names).select(*keys, *([] if distinct is None else [distinct[0]]), *plain, *names, *counts)


def exact_sum(df: DataFrame, column: Column | str) -> float | None:
    """The exact sum of a column over all rows."""
    c = F.col(column) if isinstance(column, str) else column
    row = totals(df, {"_all": F.lit(1)}, {"total": c}).first()
    return None if row is None else row["total"]


def mean(name: str) -> Column:
    """The mean of a summed column; null without values."""
    return F.col(name) / F.nullif(F.col(f"{name}_count"), F.lit(0))


def _bands_of(i: int) -> Column:
    return F.filter("_bands", lambda b: b["_of"] == i)


def _common(value: Column) -> Column:
    """The value as a decimal if that has all of its digits, else null."""
    digits = F.when(F.abs(value) < _BELOW, value).try_cast(f"decimal(28,{_DIGITS})")
    return F.when(digits.cast("double") == value, digits)


def _banded(value: Column) -> tuple[Column, Column]:
    """Exponent band of a value, and its digits in units of the band."""
    text = value.cast("string")
    parts = F.split(text, "E")
    exponent = F.coalesce(F.try_element_at(parts, F.lit(2)).cast("int"), F.lit(0))
    band = F.floor(exponent / _BAND).cast("int")
    scale = F.element_at(F.array(*[F.lit(10**r) for r in range(_BAND)]), exponent - band * _BAND + 1)
    digits = F.element_at(parts, 1).try_cast("decimal(28,20)")
    special = F.when(text == "NaN", _NAN).when(text == "Infinity", _PLUS).when(text == "-Infinity", _MINUS)
    unit = F.when(special.isNull() & value.isNotNull(), (digits * scale).cast("decimal(28,20)"))
    return F.coalesce(special, band), unit


def _together(merged: DataFrame, names: list[str]) -> DataFrame:
    """Adds for each sum the double nearest to its common decimal `_c` and the units of its bands.

    Step by step, each step's columns named, so that no expression stands in the plan twice.
    """

    def step(df: DataFrame, prefix: str, made) -> DataFrame:
        return df.select("*", *[made(i).alias(f"{prefix}{i}") for i in range(len(names))])

    df = step(merged, "_b", _bands_of)
    df = step(df, "_parts", lambda i: F.when(F.size(f"_b{i}") > 0, _parts(F.col(f"_c{i}"), F.col(f"_b{i}"))))
    df = step(df, "_low", lambda i: F.array_min(F.transform(f"_parts{i}", lambda p: p["at"])))
    # a whole part reaches over so many places
    df = step(df, "_high", lambda i: F.array_max(F.transform(f"_parts{i}", lambda p: p["at"])) + 9)
    df = step(df, "_plus", lambda i: _written(i, 1))
    df = step(df, "_minus", lambda i: F.when(F.col(f"_plus{i}.carry") < 0, _written(i, -1)))
    return df.select("*", *[_nearest(i).alias(n) for i, n in enumerate(names)])


def _parts(common: Column, bands: Column) -> Column:
    """Numbers of four digits, and whole numbers, by the place of their last digits."""

    def limb(at: Column, value: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), value.cast("decimal(30,0)").alias("value"))

    def limbs(at: Column, number: Column, digits: int) -> list[Column]:
        """A decimal's whole part as one number, then what is behind the point."""
        rest = F.pmod(number, F.lit(1).cast("decimal(1,0)"))  # a difference would lose digits
        rest = (rest * F.lit(str(10**digits)).cast(f"decimal({digits + 1},0)")).cast(f"decimal({digits},0)")
        text = F.lpad(rest.cast("string"), digits, "0")
        behind = [limb(at - k - 1, F.substring(text, 4 * k + 1, 4)) for k in range(digits // _BAND)]
        return [limb(at, F.floor(number)), *behind]

    held = F.coalesce(common, F.lit(0)).cast(f"decimal(38,{_DIGITS})")
    return F.concat(
        F.array(*limbs(F.lit(0), held, _DIGITS)),
        F.flatten(F.transform(F.filter(bands, lambda b: b["_unit"].isNotNull()), lambda b: F.array(*limbs(b["_band"], b["_unit"], 20)))),
    )


def _written(i: int, sign: int) -> Column:
    """Digits of a sum from the last place to the first, and what is carried out of it."""
    zero, base = F.lit(0).cast("decimal(30,0)"), F.lit(10_000).cast("decimal(5,0)")

    def step(so_far: Column, at: Column) -> Column:
        here = F.filter(f"_parts{i}", lambda p: p["at"] == at)
        found = F.aggregate(here, zero, lambda s, p: (s + p["value"] * sign).cast("decimal(30,0)"))
        total = (so_far["carry"] + found).cast("decimal(30,0)")
        digits = F.pmod(total, base)
        carry = ((total - digits) / base).cast("decimal(30,0)")
        text = F.concat(F.lpad(digits.cast("int").cast("string"), _BAND, "0"), so_far["text"])
        return F.struct(carry.alias("carry"), text.alias("text"))

    return F.aggregate(F.sequence(f"_low{i}", f"_high{i}"), F.struct(zero.alias("carry"), F.lit("").alias("text")), step)


def _nearest(i: int) -> Column:
    bands = F.col(f"_b{i}")

    def has(band: int) -> Column:
        return F.exists(bands, lambda b: b["_band"] == band)

    def number(digits: str) -> Column:
        return F.concat(f"{digits}{i}.text", F.lit("E"), (F.col(f"_low{i}") * _BAND).cast("string")).cast("double")

    finite = F.when(F.col(f"_plus{i}.carry") < 0, -number("_minus")).otherwise(number("_plus"))
    nan, infinity = F.lit(float("nan")), F.lit(float("inf"))
    special = F.when(has(_NAN) | (has(_PLUS) & has(_MINUS)), nan).when(has(_PLUS), infinity).when(has(_MINUS), -infinity)
    return F.when(F.size(bands) == 0, F.col(f"_c{i}").cast("double")).otherwise(F.coalesce(special, finite))
