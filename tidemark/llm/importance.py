"""Importance resampling towards a target: hashed n-gram buckets by an Aho-Corasick dictionary.

The distinct words of a slice of texts go into an automaton, each bounded by a delimiter on both
sides, with its CRC and length as payload. Scanning the slice emits the payloads of its words in
order; neighbours' payloads are composed (the CRC of a joined text follows from the CRCs of its
parts and the length of the last), so the bucket of a run of words is known without spelling it.
Buckets are counted for the corpus and the target; a document's weight is the sum of its buckets'
log ratios, and documents are drawn by weight plus Gumbel noise.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, bytes_of, indexed, mapped, slices, stored, without

BUCKETS = 10_000
NGRAM = 3
_SLICE = 8_000_000
_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
#: lower case, and every delimiter as a blank
_CANON = bytes(b if b in _WORD else 32 for b in LOWER)
#: lengths whose shift has a table of its own; longer ones are put together from powers of two
_TABLED = 64


def _shift_tables(lengths: int) -> np.ndarray:
    """[length, byte, value]: what a CRC's byte becomes when so many zero bytes follow."""
    values = np.arange(256, dtype=np.uint32)
    step = values.copy()
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    tables = [np.stack([values << np.uint32(8 * j) for j in range(4)])]
    for _ in range(lengths - 1):
        tables.append((tables[-1] >> 8) ^ step[tables[-1] & 0xFF])
    return np.stack(tables)


_TABLES = _shift_tables(_TABLED + 1)


def _through(tables: np.ndarray, which, crc: np.ndarray) -> np.ndarray:
    return tables[which, 0, crc & 0xFF] ^ tables[which, 1, crc >> 8 & 0xFF] ^ tables[which, 2, crc >> 16 & 0xFF] ^ tables[which, 3, crc >> 24]


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRCs as if so many zero bytes followed: XOR with a text's CRC gives that of both joined."""
    out = _through(_TABLES, np.minimum(lengths, _TABLED), crc)
    long = np.flatnonzero(lengths > _TABLED)
    if len(long):
        held, rest = out[long], lengths[long] - _TABLED
        power = _TABLES[1]
        while rest.any():
            odd = rest & 1 == 1
            held[odd] = _through(power[None], 0, held[odd])
            rest = rest >> 1
            power = _through(power[None], 0, power)
        out[long] = held
    return out


@dataclass
class Words:
    """A slice's words in order: CRC and length of each, and how many each text has."""

    crc: np.ndarray
    length: np.ndarray
    counts: np.ndarray

    def buckets(self, ngram: int, buckets: int) -> list[np.ndarray]:
        """For runs of 1, 2, ... words: each run's bucket, by its first word; -1 where the text ends before."""
        ends = np.repeat(np.cumsum(self.counts), self.counts)
        place = np.arange(len(self.crc))
        crc, out = self.crc, [(self.crc % buckets).astype(np.int64)]
        blank = np.full(len(crc), zlib.crc32(b" "), np.uint32)
        spaced = shifted(blank, self.length) ^ self.crc  # of a blank and the word
        for n in range(1, ngram):
            crc = shifted(crc[:-1], self.length[n:] + 1) ^ spaced[n:]
            whole = place[: len(crc)] + n < ends[: len(crc)]
            out.append(np.where(whole, (crc % buckets).astype(np.int64), -1))
        return out


def scan(texts: list[bytes]) -> Words:
    """The words of texts, by an automaton over the texts' own distinct words."""
    canon = [t.translate(_CANON) for t in texts]
    joined = b" " + b" ".join(canon) + b" "
    words = ahocorasick.Automaton()
    for word in set(joined.split()):
        words.add_word(f" {word.decode('latin-1')} ", zlib.crc32(word) << 31 | len(word))
    if not len(words):
        none = np.zeros(0, np.uint32)
        return Words(none, none.astype(np.int64), np.zeros(len(texts), np.int64))
    words.make_automaton()
    found = np.fromiter(words.iter(joined.decode("latin-1")), np.dtype([("end", np.int64), ("payload", np.int64)]))
    ends = np.cumsum([len(t) + 1 for t in canon])  # of the blank that bounds each text's last word
    counts = np.diff(np.searchsorted(found["end"], ends, side="right"), prepend=0)
    return Words((found["payload"] >> 31).astype(np.uint32), found["payload"] & (1 << 31) - 1, counts)


def bucket_counts(df: DataFrame, text: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, features) over all texts, null ones without a word. A task gives a row a bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                for found in scan(bytes_of(part, "text")).buckets(ngram, buckets):
                    total += np.bincount(found[found >= 0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "features"])

    counted = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket long, features long")
    return counted.groupBy("bucket").agg(F.sum("features").alias("features"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """A thousand times the log ratio of each bucket's share in the target to that in the corpus,
    one added to every count, rounded down. Both counts have at most a row a bucket."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for held, counts in ((s, corpus), (t, target)):
        for row in counts.collect():
            held[row["bucket"]] = row["features"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(df: DataFrame, gain: np.ndarray, text: str = "text", ngram: int = NGRAM) -> DataFrame:
    """All rows and columns, with n_words, n_features and weight, the sum of the features' gains.

    A text without a word, or null, has 0 of each. Columns of these names are replaced.
    """

    def run(part):
        words = scan(bytes_of(part, "_text"))
        of_word = np.zeros(len(words.crc), np.int64)
        padded = np.append(gain, 0)
        for found in words.buckets(ngram, len(gain)):
            of_word[: len(found)] += padded[found]
        ends = np.cumsum(words.counts)
        sums = np.concatenate(([0], np.cumsum(of_word)))
        features = sum(np.maximum(words.counts - n, 0) for n in range(ngram))
        return [words.counts, features, sums[ends] - sums[ends - words.counts]]

    return mapped(df, text, _SLICE, {"n_words": "long", "n_features": "long", "weight": "long"}, run)


def gumbel(doc_id: str, seed: int) -> Column:
    """A thousand times a Gumbel variate that hangs on seed and id alone, rounded down; null for a null id."""
    text = F.concat(F.lit(f"{seed}:"), F.col(f"`{doc_id}`").cast("string"))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(df: DataFrame, share: tuple[int, int], doc_id: str = "doc_id", least_words: int = 20, seed: int = 42) -> DataFrame:
    """All rows and columns, with score and rank: of the N rows with an id and enough words, the
    floor(share of N) with the highest scores are ranked from 1, the others' rank is null.

    share is a fraction (numerator, denominator). Ties go to the smaller id, then to the smaller
    weight and fewer features; rows alike in all of these get their ranks in any order. A null id
    has no score and is not drawn. Needs weigh's columns; score and rank are replaced.
    """
    scored = without(df, ["score", "rank"]).withColumn("score", F.col("weight") + gumbel(doc_id, seed))
    scored = stored(scored, "scored")
    fit = F.coalesce((F.col("n_words") >= least_words) & F.col(f"`{doc_id}`").isNotNull(), F.lit(False))
    most = scored.filter(fit).count() * share[0] // share[1]
    ordered = indexed(scored.filter(fit), [F.col("score").desc(), F.col(f"`{doc_id}`"), "weight", "n_features"], "_place")
    rank = F.when(F.col("_place") < most, F.col("_place") + 1).cast("long").alias("rank")
    ranked = ordered.select(*[F.col(f"`{c}`") for c in scored.columns], rank)
    return ranked.unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
