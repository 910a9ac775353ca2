"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import new_folder

#: Fixed value: the characters that count as white space between words, and upper to lower case.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the folder that all executors share and read back: later steps read the files,
    so that neither a lost executor nor a second use computes the rows again."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def crc_remainder(doc_id: str, divisor: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % divisor


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that a slice holds at most so many bytes of a column, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts, nulls as empty."""
    return [x or "" for x in batch[column].to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of the texts, nulls as empty."""
    return [x or b"" for x in batch[column].cast(pa.binary()).to_pylist()]


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame without columns that have one of the names, in any case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def mapped(df: DataFrame, text: str, most: int, new: dict[str, str], fn) -> DataFrame:
    """The frame with new columns computed from its rows in Arrow batches.

    fn(slice) gives the new columns' arrays for a slice of at most `most` bytes of text.
    A column of the same name is replaced.
    """
    kept = without(df, list(new))
    source = df.select(F.col(f"`{text}`").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_row"))
    added = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in new.items()])
    schema = T.StructType([T.StructField("_row", source.schema["_row"].dataType), *added])
    kinds = [f.type for f in to_arrow_schema(added)]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text", most):
                arrays = [a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(fn(part), kinds)]
                yield pa.RecordBatch.from_arrays([part["_row"], *arrays], names=["_row", *new])

    out = source.mapInArrow(run, schema)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept.columns], *new)


def indexed(df: DataFrame, order: list[Column | str], out: str = "index") -> DataFrame:
    """The stored rows with their place, from 0, in an order of the whole table.

    Every task sorts one range and numbers its rows; only the ranges' row counts, one row a range,
    are added up in one place and sent to all tasks. df is read twice, so it must be stored or
    cheap. Rows that the order leaves equal get consecutive places in any order, and may be dealt
    over several ranges. A column named `out` is replaced.
    """
    tied = without(df, [out]).withColumn("_tie", F.monotonically_increasing_id())
    spread = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = stored(spread.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    # the id is the number of the task's range above 33 bits of the row's number in it
    placed = placed.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    found = placed.join(F.broadcast(starts), "_range").withColumn(out, F.col("_start") + F.col("_at"))
    return found.drop("_range", "_at", "_start")
