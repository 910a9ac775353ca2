"""Line dedup by a log-template tree of fixed depth.

A line is parsed down a tree: first by its number of tokens, then by its leading tokens, where a
token with a digit is a variable field. Below such a leaf stand the line's templates: its tokens
with variable fields generalised, and two wider ones that leave every second remaining token open,
so that lines of a leaf which differ in some fields meet in one of them. Of a template that recurs the
document with the smallest id keeps its lines, as do whole copies of it, so that they stay equal.
Others lose them, be they single lines or passages of many. Only a document that has most of its
lines in common with that first one is a near copy of it, left to document dedup; it loses what
recurs amid different neighbouring lines.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored, texts_of, without

LEADING = 3
#: lines of fewer tokens may be equal by chance and must recur in more documents
SHORT = 8
DOCUMENTS = 2
DOCUMENTS_SHORT = 5
FIELD = "<*>"
_SLICE = 4_000_000
_SEEDS = (1, 2, 3)
_VARIABLE = re.compile(r"\S*\d\S*")


def _hash(text: str, seed: int) -> int:
    return xxhash.xxh64_intdigest(text, seed) - (1 << 63)


def parse(line: str) -> tuple[int, int, list[int]]:
    """Number of tokens, the leaf, and the templates from the narrowest to the widest, as hashes.

    Every template includes the leaf: the number of tokens and the leading ones.
    """
    tokens = _VARIABLE.sub(FIELD, line).split()
    leaf = f"{len(tokens)} {' '.join(tokens[:LEADING])}\n"
    rest = tokens[LEADING:]
    bodies = [rest, rest[::2], rest[1::2]] if len(tokens) >= SHORT else [rest]
    return len(tokens), _hash(leaf, 0), [_hash(leaf + " ".join(b), s) for b, s in zip(bodies, _SEEDS)]


def line_templates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per template of each line that isn't blank: doc_id, text_hash, lines (how many such lines
    the text has), line (its number from 0), tokens, template, before and after (leaves of the neighbouring lines; at an end of the text
    the other neighbour, 0 without any) and again (an earlier line of the document has it)."""
    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(f"`{text}`").alias("_text"))
    names = ["doc_id", "text_hash", "lines", "line", "tokens", "template", "before", "after", "again"]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text", _SLICE):
                rows, docs = [], []
                for i, whole in enumerate(texts_of(part, "_text")):
                    found = [(n, *parse(x)) for n, x in enumerate(whole.split("\n")) if x.strip()]
                    own = [leaf for _, _, leaf, _ in found]
                    seen: set[int] = set()
                    for j, (n, size, _, templates) in enumerate(found):
                        before = own[j - 1] if j else (own[1] if len(own) > 1 else 0)
                        after = own[j + 1] if j + 1 < len(own) else (own[j - 1] if j else 0)
                        for t in templates:
                            rows.append((len(found), n, size, t, before, after, t in seen))
                            docs.append(i)
                            seen.add(t)
                at = pa.array(docs, pa.int64())
                columns = list(zip(*rows)) if rows else [[]] * 7
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(at), part["text_hash"].take(at), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names
                )

    return source.mapInArrow(run, "doc_id long, text_hash long, lines int, line int, tokens int, template long, before long, after long, again boolean")


def recurring(lines: DataFrame, documents: int = DOCUMENTS, documents_short: int = DOCUMENTS_SHORT) -> DataFrame:
    """Templates that more than one document has: template, first (the smallest doc_id with its
    text_hash and lines), documents, enough (they are as many as asked for) and apart (with different
    neighbours). Lines without doc_id count, but are never the first."""
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash", "lines"))
    counted = lines.groupBy("template").agg(
        F.min(named).alias("first"),
        F.count(F.when(~F.col("again"), 1)).alias("documents"),
        F.min("tokens").alias("tokens"),
        *[f(c).alias(f"{n}_{c}") for c in ("before", "after") for f, n in ((F.min, "min"), (F.max, "max"))],
    )
    needed = F.when(F.col("tokens") < SHORT, documents_short).otherwise(documents)
    differ = (F.col("min_before") != F.col("max_before")) & (F.col("min_after") != F.col("max_after"))
    found = counted.filter((F.col("documents") > 1) & F.col("first").isNotNull())
    return found.select("template", "first", "documents", (F.col("documents") >= needed).alias("enough"), differ.alias("apart"))


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, documents_short: int = DOCUMENTS_SHORT) -> DataFrame:
    """All rows and columns, the text without the lines whose template recurs, and dropped_lines.

    dropped_lines (array<int>) holds the numbers of the lines that were cut, null if none was. Blank
    lines stay. A null text stays null. Repeated rows with one id and text are treated alike, and
    count as so many documents. A column named dropped_lines is replaced.
    """
    lines = stored(line_templates(df, doc_id, text), "lines")
    again = recurring(lines, documents, documents_short)
    shared = (
        lines.select("doc_id", "text_hash", "lines", "line", "template")
        .join(again, "template")
        .filter(~F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") != F.col("first.text_hash")))
        .groupBy("doc_id", "text_hash", "lines", "first")
        .agg(
            F.size(F.collect_set("line")).alias("common"),
            F.collect_set(F.when(F.col("enough"), F.col("line"))).alias("found"),
            F.collect_set(F.when(F.col("enough") & F.col("apart"), F.col("line"))).alias("apart"),
        )
    )
    copy = F.col("common") * 2 > F.greatest("lines", "first.lines")
    dropped = (
        shared.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.when(copy, F.col("apart")).otherwise(F.col("found")).alias("gone"))
        .filter(F.size("gone") > 0)
        .groupBy("_id", "_hash")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("dropped_lines"))
    )
    kept = without(df, ["dropped_lines"])
    same = kept[doc_id].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(kept[text]) == F.col("_hash"))
    joined = kept.join(dropped, same, "left")
    split = F.split(F.col(f"`{text}`"), "\n", -1)
    left = F.array_join(F.filter(split, lambda x, i: ~F.array_contains("dropped_lines", i)), "\n")
    cut = F.when(F.col("dropped_lines").isNull(), F.col(f"`{text}`")).otherwise(left)
    return joined.select(*[cut.alias(c) if c == text else F.col(f"`{c}`") for c in kept.columns], "dropped_lines")
