"""Substring dedup by level-wise doubling: words inside a passage that an earlier document has too go.

Lengths double up to the wanted one (for 13 words: 7, then 13). Only what repeats at one length is
extended to the next, until nothing survives or the wanted length is reached. Of the shortest
length a text gives just the windows that are least, by their hash, in a window of the next length:
equal windows choose equally, so nothing is missed, and a quarter of the windows travels. A longer
window is a candidate if its parts repeat, and its hash is put together from theirs.

A task looks through its own windows first, in slices: what is repeated within a slice is known
there, and a slice sends one row for each window at most, however many documents hold it. So a
window that is everywhere costs a row per slice, not one per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bytes_of, slices, stored, without

WORDS = 13
#: the doubling begins at this length or below
SHORTEST = 7
_SLICE = 8_000_000
_CACHED = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([int.from_bytes(xxhash.xxh64_digest(str(i).encode()), "big") | 1 for i in range(4 * SHORTEST)], np.uint64)
_ROWS = "window long, tag long, doc_id long"
#: of a tag: the row is known to be kept on; the bits below are the check
_KNOWN = 1 << 40


def lengths(words: int) -> list[int]:
    """The lengths gone through: each is at most twice the one before it."""
    out = [words]
    while out[0] > SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


class _Hashes(dict):
    """Word to its hash, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _windows(words: np.ndarray, steps: list[int]) -> list[np.ndarray]:
    """For each length: two independent hashes (rows) of every window of so many words."""
    first, out = steps[0], []
    if len(words) < first:
        return [np.zeros((2, 0), np.uint64) for _ in steps]
    n = len(words) - first + 1
    base = [sum(words[j : j + n] * _ODD[2 * j + k] for j in range(first)) for k in (0, 1)]
    out.append(np.stack([_mixed(h) for h in base]))
    for before, length in zip(steps, steps[1:]):
        shift, n = length - before, max(len(words) - length + 1, 0)
        odd = _ODD[2 * SHORTEST :]
        out.append(np.stack([_mixed(out[-1][k, :n] * odd[2 * k] + out[-1][k, shift : shift + n] * odd[2 * k + 1]) for k in (0, 1)]))
    return out


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        h = np.minimum(h[:-step], h[step:])
        done += step
    return h


def _candidates(found: list[np.ndarray], steps: list[int], level: int, repeated: np.ndarray) -> np.ndarray:
    """Which windows of a level are made of what repeats at the level before."""
    shift, n = steps[level] - steps[level - 1], found[level].shape[1]
    if not n:
        return np.zeros(0, bool)
    before = found[level - 1][0]
    if level == 1:
        return np.isin(_least(before, shift + 1), repeated)
    known = np.isin(before, repeated)
    return known[:n] & known[shift : shift + n]


def _combined(window: np.ndarray, check: np.ndarray, doc: np.ndarray, last: bool) -> pa.RecordBatch:
    """A slice's rows: those known to repeat (at the last level: not to be the first), and at most
    one row for each window that goes on to meet the other slices'."""
    order = np.lexsort((doc, check, window))
    window, check, doc = window[order], check[order], doc[order]
    begins = _begins(window, check)
    first = doc[np.flatnonzero(begins)][np.cumsum(begins) - 1] if len(doc) else doc
    later = doc != first
    if last:
        known, sent = later, begins
    else:
        group = np.cumsum(begins) - 1
        known, sent = np.bincount(group, later)[group] > 0 if len(doc) else later, begins
    at = np.concatenate((np.flatnonzero(known), np.flatnonzero(sent)))
    tag = check[at].astype(np.int64)
    tag[: np.count_nonzero(known)] |= _KNOWN
    arrays = [pa.array(window[at].view(np.int64)), pa.array(tag), pa.array(doc[at])]
    return pa.RecordBatch.from_arrays(arrays, names=["window", "tag", "doc_id"])


def _begins(window: np.ndarray, check: np.ndarray) -> np.ndarray:
    out = np.ones(len(window), bool)
    out[1:] = (window[1:] != window[:-1]) | (check[1:] != check[:-1])
    return out


def _emitted(doc_id: str, text: str, steps: list[int], level: int, last: bool):
    """Rows of a level from ids, texts and, above the first, what repeats, slice by slice."""
    sampled = level == 0 and len(steps) > 1

    def run(batches: Iterator[pa.RecordBatch]):
        words_of = _Hashes()
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                windows, checks, docs = [], [], []
                repeated = part["_repeated"] if level else None
                for i, (doc, whole) in enumerate(zip(part[doc_id].to_pylist(), bytes_of(part, text))):
                    words = np.array([words_of[w] for w in whole.split()], np.uint64)
                    found = _windows(words, steps[: level + 1 + sampled])
                    h, c = found[level]
                    if level:
                        own = _candidates(found, steps, level, repeated[i].values.to_numpy().view(np.uint64))
                        h, at = np.unique(h[own], return_index=True)
                        c = c[own][at]
                    elif sampled:  # candidates only, so they need no check
                        h = np.unique(_least(h, steps[1] - steps[0] + 1)) if found[1].size else h[:0]
                        c = np.zeros(len(h), np.uint64)
                    else:
                        h, at = np.unique(h, return_index=True)
                        c = c[at]
                    windows.append(h)
                    checks.append(c >> np.uint64(33))
                    docs.append(np.full(len(h), doc, np.int64))
                yield _combined(np.concatenate(windows), np.concatenate(checks), np.concatenate(docs), last)

    return run


def _met(last: bool):
    """Goes through rows sorted by window and document, and passes on those that repeat; at the last
    level only those with an earlier document. Holds one row between batches."""

    def run(batches: Iterator[pa.RecordBatch]):
        held = None
        for batch in batches:
            window, check, doc = (batch[c].to_numpy() for c in ("window", "tag", "doc_id"))
            known = check >= _KNOWN
            if known.any():
                yield _found(doc[known], window[known])
                window, check, doc = window[~known], check[~known], doc[~known]
            if not len(window):
                continue
            if held is not None:
                window, check, doc = (np.concatenate(([h], x)) for h, x in zip(held, (window, check, doc)))
            begins = _begins(window, check)
            group = np.cumsum(begins) - 1
            first = np.flatnonzero(begins)
            chosen = doc != doc[first][group]
            if not last:
                chosen = np.bincount(group, chosen)[group] > 0
            yield _found(doc[chosen], window[chosen])
            at = first[-1]
            held = window[at], check[at], doc[at]

    return run


def _found(doc: np.ndarray, window: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(window)], names=["_id", "window"])


def _survivors(rows: DataFrame, last: bool) -> DataFrame:
    """(_id, _repeated): the windows of each document that repeat, by the rows of all slices."""
    # what is known already has no one to meet, and is spread by document
    met = rows.repartition(F.when(F.col("tag") >= _KNOWN, F.xxhash64("doc_id")).otherwise(F.col("window")))
    found = met.sortWithinPartitions("window", "tag", "doc_id").mapInArrow(_met(last), "_id long, window long")
    return found.groupBy("_id").agg(F.collect_list("window").alias("_repeated"))


def _level(docs: DataFrame, survivors: DataFrame | None, steps: list[int], level: int, last: bool) -> DataFrame:
    doc_id, text = docs.columns
    read = docs if survivors is None else docs.join(survivors, docs[doc_id] == survivors["_id"]).drop("_id")
    return _survivors(read.mapInArrow(_emitted(doc_id, text, steps, level, last), _ROWS), last)


def _with_id(df: DataFrame, doc_id: str) -> DataFrame:
    return df.withColumn(doc_id, F.col(f"`{doc_id}`").cast("long")).filter(F.col(f"`{doc_id}`").isNotNull())


def repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(_id, _repeated): for each document with a window of so many words that also begins in a
    document with a smaller id, the hashes of these windows. Rows without an id take no part."""
    steps, survivors = lengths(words), None
    docs = _with_id(df, doc_id).select(doc_id, text)
    for level in range(len(steps)):
        survivors = _level(docs, survivors, steps, level, level == len(steps) - 1)
    return survivors


def cut(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """All rows and columns, with n_words, removed (half-open spans of word positions), n_removed and
    kept, the words that stay, joined by blanks.

    A word goes if a window of `words` words of its text covers it that also begins in a document
    with a smaller id. Windows are judged on the texts as they are given; repeats within a document,
    or between rows with one id, stay. Rows without an id keep all words and take nothing from
    others. A null or empty text has no words, and kept is empty. Columns of these names are replaced.
    df is read several times, so it must be stored or cheap.
    """
    new = {"n_words": "long", "removed": "array<struct<start:long,end:long>>", "n_removed": "long", "kept": "string"}
    kept = without(df, list(new))
    # with no other columns than these two, Spark uses the shuffle that the levels read once more
    held = _with_id(kept, doc_id).select(doc_id, text, *[c for c in kept.columns if c not in (doc_id, text)])
    found = repeats(kept, doc_id, text, words)
    joined = held.join(found, held[doc_id] == found["_id"], "left").drop("_id")
    no_id = kept.filter(F.col(f"`{doc_id}`").isNull()).withColumn("_repeated", F.lit(None).cast("array<long>"))
    row = F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_row")
    every = joined.unionByName(no_id).select(row, F.col(f"`{text}`").alias("_text"), "_repeated")

    steps = lengths(words)

    def run(batches: Iterator[pa.RecordBatch]):
        words_of = _Hashes()
        for batch in batches:
            for part in slices(batch, "_text", _SLICE):
                out = []
                for i, whole in enumerate(bytes_of(part, "_text")):
                    repeated = part["_repeated"][i]
                    out.append(_cut(whole.split(), repeated.values.to_numpy().view(np.uint64) if repeated.is_valid else None, steps, words_of))
                arrays = [pa.array(x, k) for x, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([part["_row"], *arrays], names=["_row", *new])

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), span, pa.int64(), pa.string()]
    schema = T.StructType([every.schema["_row"], *[T.StructField(n, T._parse_datatype_string(t)) for n, t in new.items()]])
    done = every.mapInArrow(run, schema)
    return done.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept.columns], *new)


def _cut(words: list[bytes], repeated: np.ndarray | None, steps: list[int], words_of: _Hashes) -> tuple:
    if repeated is None or len(words) < steps[-1]:
        return len(words), [], 0, b" ".join(words).decode()
    windows = _windows(np.array([words_of[w] for w in words], np.uint64), steps)[-1][0]
    starts = np.flatnonzero(np.isin(windows, repeated))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + steps[-1], -1)
    gone = np.cumsum(edge)[:-1] > 0
    turns = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
    spans = [{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]
    kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
    return len(words), spans, int(gone.sum()), kept.decode()


def longest(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, words): for each document that shares a window with one of another id, the greatest
    of the lengths words, 2 words, 4 words ... of such windows.

    What repeats at one length is stored and extended to twice that length, until nothing survives.
    Rows without an id take no part. df must be stored or cheap.
    """
    steps, survivors, level = lengths(words), None, 0
    docs = _with_id(df, doc_id).select(doc_id, text)
    out = df.sparkSession.createDataFrame([], "doc_id long, words long")
    while True:
        if level == len(steps):
            steps = [*steps, 2 * steps[-1]]
        survivors = stored(_level(docs, survivors, steps, level, False), "repeats")
        if survivors.isEmpty():
            return out.groupBy("doc_id").agg(F.max("words").alias("words"))
        if steps[level] >= words:
            out = out.unionByName(survivors.select(F.col("_id").alias("doc_id"), F.lit(steps[level]).cast("long").alias("words")))
        level += 1
