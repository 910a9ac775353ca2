"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts longer than a chunk are cut into chunks that overlap. Chunks are split into pre-tokens in
parallel, each from its own start, which may lie inside a pre-token. Because a match depends only
on where it starts and on what follows, two chunks agree from the first place on where both begin a
pre-token; there they are stitched. Where an overlap has no such place, the left chunk's
splitting is carried on until it meets one. Then the pieces are encoded. Decoding concatenates the
tokens' raw bytes.
"""

from __future__ import annotations

import base64
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import pretokens
from tidemark.llm.common import mapped, slices, texts_of, without

CHUNK = 16_384
OVERLAP = 512
#: A match is sure if so many characters of the text are known behind it: a contraction is decided
#: by two more characters, a run or its white space by one.
SURE = 3
_SLICE = 1_000_000
_REMEMBERED = 100_000


class Encoder:
    """Ids of pre-tokens, remembered up to a bound."""

    def __init__(self, ranks_path: str):
        # one match is merged at a time: the pattern takes all of it
        self.merge = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=_ranks(ranks_path), special_tokens={})
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def new(self, piece: str) -> bytes:
        if len(self.known) >= _REMEMBERED:
            self.known, self.before = {}, self.known
        ids = self.known[piece] = self.before.get(piece) or array("i", self.merge.encode_ordinary(piece)).tobytes()
        return ids

    def ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, four bytes each."""
        new = self.new
        return [self.known.get(p) or new(p) for p in pieces]

    def encode(self, texts: list[str]) -> pa.ListArray:
        pieces, _, counts = pretokens.split(texts)
        return self.listed(self.ids(pieces), counts)

    @staticmethod
    def listed(ids: list[bytes], counts: np.ndarray) -> pa.ListArray:
        """One list per text from the ids of its pieces."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.frombuffer(b"".join(ids), np.int32)
        offsets = (ends[np.concatenate(([0], np.cumsum(counts)))] // 4).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, flat)


@cache
def encoder(ranks_path: str) -> Encoder:
    return Encoder(ranks_path)


def _ranks(ranks_path: str) -> dict[bytes, int]:
    with open(ranks_path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def bytes_table(ranks_path: str) -> list[bytes]:
    """The bytes of each id. A worker that only decodes needs no more than this."""
    ranks = _ranks(ranks_path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for raw, i in ranks.items():
        table[i] = raw
    return table


def decoded(ids: pa.ListArray, ranks_path: str) -> list[bytes]:
    """The concatenated bytes of each list of ids; null as none. An id without a token raises."""
    table = bytes_table(ranks_path)
    flat = ids.flatten().to_pylist()
    raw, at = [], 0
    for n in [x or 0 for x in ids.value_lengths().to_pylist()]:
        raw.append(b"".join(map(table.__getitem__, flat[at : at + n])))
        at += n
    return raw


def sure_ends(text: str, last: bool) -> np.ndarray:
    """Ends of pre-tokens when splitting from the start of `text`, as far as they are sure.

    last: nothing follows the text.
    """
    starts = pretokens.boundaries(pretokens.code_points(text), np.zeros(min(1, len(text)), np.int64))
    ends = np.append(starts[1:], len(text)) if text else starts
    return ends if last else ends[ends <= len(text) - SURE]


def stitched(chunks: list[str], ends: list[np.ndarray], step: int) -> tuple[str, np.ndarray]:
    """The whole text and the ends of its pre-tokens, from overlapping chunks `step` apart.

    ends: of each chunk, counted from its own start.
    """
    text = "".join(c[:step] for c in chunks[:-1]) + chunks[-1]
    done: list[np.ndarray] = []
    mine = ends[0]  # the true ends, from `reached` on
    reached = 0
    for i in range(1, len(chunks)):
        base = i * step
        theirs = np.concatenate(([base], ends[i] + base))
        seam = _meeting(mine, theirs, base)
        if seam is None:
            before = mine[mine > reached]
            at = int(before[-1]) if len(before) else reached
            done.append(before)
            reached = at
            known = base + len(chunks[i])
            mine = sure_ends(text[at:known], known == len(text)) + at
            seam = _meeting(mine, theirs, base)
            if seam is None:
                continue
        done.append(mine[(mine > reached) & (mine <= seam)])
        mine, reached = theirs, seam
    done.append(mine[mine > reached])
    return text, np.concatenate(done)


def _meeting(mine: np.ndarray, theirs: np.ndarray, base: int) -> int | None:
    both = np.intersect1d(mine[mine >= base], theirs, assume_unique=True)
    return int(both[0]) if len(both) else None


def encode(df: DataFrame, ranks_path: str, text: str = "text", out: str = "ids", chunk: int = CHUNK, overlap: int = OVERLAP, back: str | None = None) -> DataFrame:
    """All rows and columns, with the token ids of each whole text as `array<int>`, and, if `back`
    names a column, the bytes that decoding these ids gives, as `binary`.

    A null or empty text has no ids. Columns already named so are replaced. Repeated rows stay,
    each with its ids. Texts of any length are encoded whole; only the chunks of texts longer than
    one chunk are shuffled. df must be stored or come in the same order again: a long text's chunks
    are told by the number of their row.
    """
    length = F.coalesce(F.length(F.col(f"`{text}`")), F.lit(0))
    new = {out: "array<int>", **({back: "binary"} if back else {})}

    def run(part):
        ids = encoder(ranks_path).encode(texts_of(part, "_text"))
        return [ids, decoded(ids, ranks_path)] if back else [ids]

    short = mapped(df.filter(length <= chunk), text, _SLICE, new, run)
    long = _encode_long(df.filter(length > chunk), ranks_path, text, out, chunk, overlap, back)
    return short.unionByName(long)


def _encode_long(df: DataFrame, ranks_path: str, text: str, out: str, step: int, overlap: int, back: str | None) -> DataFrame:
    kept = without(df, [out, back] if back else [out])
    row = F.struct(*[F.col(f"`{c}`") for c in kept.columns if c != text])
    source = df.select(F.monotonically_increasing_id().alias("_id"), row.alias("_row"), F.col(f"`{text}`").alias("_text"))
    kind = source.schema["_row"].dataType
    chunked = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_no", T.IntegerType()), T.StructField("_last", T.BooleanType()), T.StructField("_row", kind), T.StructField("_text", T.StringType())])

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "_text", 1):
                whole = part["_text"][0].as_py()
                starts = range(0, max(1, len(whole) - overlap), step)
                n = len(starts)
                rows = pa.concat_arrays([part["_row"], pa.nulls(n - 1, part["_row"].type)])  # other columns travel once
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part["_id"][0].as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([s == starts[-1] for s in starts]), rows,
                     pa.array([whole[s : s + step + overlap] if s != starts[-1] else whole[s:] for s in starts])],
                    names=["_id", "_no", "_last", "_row", "_text"],
                )

    def pretokenise(batches):
        for batch in batches:
            ends = [sure_ends(t, z).astype("<i4").tobytes() for t, z in zip(batch["_text"].to_pylist(), batch["_last"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())], names=[*batch.schema.names, "_ends"])

    def stitch(group: pa.Table) -> pa.Table:
        group = group.sort_by("_no")
        chunks = group["_text"].to_pylist()
        ends = [np.frombuffer(x, "<i4").astype(np.int64) for x in group["_ends"].to_pylist()]
        whole, cuts = stitched(chunks, ends, step)
        pieces = [whole[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist())]
        ids = Encoder.listed(encoder(ranks_path).ids(pieces), np.array([len(pieces)]))
        raw = [pa.array(decoded(ids, ranks_path), pa.binary())] if back else []
        return pa.table([group["_row"].combine_chunks()[:1], pa.array([whole]), ids, *raw], names=["_row", "_text", "_ids", *["_back"][: len(raw)]])

    chunks = source.mapInArrow(cut, chunked).repartition("_id", "_no")
    split = chunks.mapInArrow(pretokenise, T.StructType([*chunked, T.StructField("_ends", T.BinaryType())]))
    more = [T.StructField("_back", T.BinaryType())] if back else []
    done = split.groupBy("_id").applyInArrow(stitch, T.StructType([chunked["_row"], chunked["_text"], T.StructField("_ids", T.ArrayType(T.IntegerType())), *more]))
    columns = [F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in kept.columns]
    return done.select(*columns, F.col("_ids").alias(out), *([F.col("_back").alias(back)] if back else []))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All rows and columns, with the concatenated bytes of the ids as `binary`.

    Null or empty ids give empty bytes; an id without a token raises. A column named `out` is
    replaced.
    """
    kept = without(df, [out])
    source = df.select(F.col(f"`{ids}`").alias("_ids"), F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_row"))
    schema = T.StructType([source.schema["_row"], T.StructField(out, T.BinaryType())])

    def batches_of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                yield pa.RecordBatch.from_arrays([part["_row"], pa.array(decoded(part["_ids"], ranks_path), pa.binary())], names=["_row", out])

    return source.mapInArrow(batches_of, schema).select(*[F.col(f"_row.`{c}`").alias(c) for c in kept.columns], out)
