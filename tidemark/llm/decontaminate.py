"""Benchmark decontamination by canonical templates.

Tokens of a text are lower-cased and stripped of punctuation; numbers, names (capitalised inside a
sentence) and units become typed slots. Windows of such a template are hashed and looked up among
the benchmark's windows; of a window of mostly slots, which says too little as a template, the values
are hashed instead, so that it matches exact copies. Matching windows on one diagonal are a region, in which the slots of both
sides are compared: each value must stand for one value throughout, as it does when a question was
asked anew with other numbers or names. A document leaks an item if consistent regions cover enough
of it.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices, texts_of, without

WINDOW = 8
#: a leak covers this share of an item's tokens, or so many tokens of it
SHARE, TOKENS = 0.5, 20
#: of a region's slots, so many may disagree
CONFLICTS = 0.1
#: a window of more items than this is common: it is counted for an item that a rarer one has hit
COMMON = 16
#: characters of benchmark text that are looked up, and sent to every task, at a time
BLOCK_CHARS = 8_000_000
PLAIN, NUMBER, NAME, UNIT = range(4)
#: Names of units.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg lb oz ml l gal s sec min h hr hours hour minutes minute seconds second days day "
    "weeks week months month years year meters meter metres metre miles mile feet foot inches inch grams gram "
    "kilograms kilogram pounds pound liters liter litres litre dollars dollar euros euro cents cent percent degrees "
    "mph kph km/h $ € £ %".split()
)
_SLICE = 4_000_000
_KNOWN = 1 << 19
_STRIP = string.punctuation + "«»“”‘’„…¿¡–—"
_NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SENTENCE = (".", "!", "?", ":", '."', '!"', '?"')


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text, 3)


_SLOT = np.array([0, *(_hash(f"<{k}>") for k in ("number", "name", "unit"))], np.uint64)


class Words:
    """What is known of tokens: the hash of the stripped token, its kind and whether it ends a
    sentence; as many tokens as fit, then it begins anew."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.at: dict[str, int] = {}
        self.hashes = np.zeros(_KNOWN, np.uint64)
        self.kinds = np.zeros(_KNOWN, np.uint8)
        self.capital = np.zeros(_KNOWN, bool)
        self.ends = np.zeros(_KNOWN, bool)

    def new(self, token: str) -> int:
        i = self.at[token] = len(self.at)
        bare = token.strip(_STRIP)
        lower = bare.lower()
        self.hashes[i] = _hash(lower)
        if _NUMBER.fullmatch(bare):
            self.kinds[i] = NUMBER
        elif (lower or token) in UNITS:
            self.kinds[i] = UNIT
        self.capital[i] = bare[:1].isupper() and not (len(bare) > 1 and bare.isupper()) and len(bare) > 1
        self.ends[i] = token.endswith(_SENTENCE)
        return i

    def read(self, texts: list[str]):
        """Of all tokens of the texts: hash of the value, hash in the template, kind, text number."""
        rows = [t.split() for t in texts]
        if len(self.at) + sum(map(len, rows)) > _KNOWN and len(self.at) + len(set().union(*rows)) > _KNOWN:
            self.clear()
        find, new = self.at.get, self.new
        places = [np.fromiter((j if (j := find(w)) is not None else new(w) for w in row), np.int64, len(row)) for row in rows]
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        value, kind = self.hashes[at], self.kinds[at].copy()
        begins = np.ones(len(at), bool)
        begins[1:] = self.ends[at[:-1]] | (doc[1:] != doc[:-1])
        kind[(kind == PLAIN) & self.capital[at] & ~begins] = NAME
        return value, np.where(kind == PLAIN, value, _SLOT[kind]), kind, doc


def windows(template: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of so many tokens."""
    n = len(template) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = (out ^ template[i : i + n]) * _FACTOR
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Items:
    """Part of a benchmark, as windows that are looked up.

    A window that many items share, as an opening that they all have, is no reason to compare a text
    with each of them. Where an item's common windows don't cover enough of it for a leak, one of its
    others must be in the text as well, so the common ones wait in `later` until one is. An item that
    common windows do cover enough of has all of them looked up. Either way no leak is lost.
    """

    ids: list[int]
    sizes: np.ndarray
    values: list[np.ndarray]
    kinds: list[np.ndarray]
    tables: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # by window size and whether values are hashed
    later: dict[int, list[tuple[tuple[int, bool], np.ndarray, np.ndarray]]]  # by item: kind of window, hashes in order, places

    @classmethod
    def of(cls, rows: list[tuple[int, str]], window: int, share: float = SHARE, tokens: int = TOKENS) -> Items:
        value, template, kind, doc = _read_all([t for _, t in rows])
        ends = np.searchsorted(doc, np.arange(len(rows) + 1))
        spans = list(zip(ends, ends[1:]))
        found: dict[tuple[int, bool], list] = {}
        for i, (a, b) in enumerate(spans):
            size = min(window, b - a)
            if size < 2:
                continue
            plain = np.convolve(kind[a:b] == PLAIN, np.ones(size, int), "valid")
            slots = plain * 2 < size  # such a template says too little, the values tell
            for exact, row, at in ((False, template, np.flatnonzero(~slots)), (True, value, np.flatnonzero(slots))):
                if len(at):
                    found.setdefault((int(size), exact), []).append((windows(row[a:b], size)[at], np.full(len(at), i), at))
        sizes = np.diff(ends)
        sorted_, covered = {}, [np.zeros(n, bool) for n in sizes]
        for key, parts in found.items():
            h, item, place = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            h, item, place = h[order], item[order], place[order]
            new = np.append(True, (h[1:] != h[:-1]) | (item[1:] != item[:-1]))  # an item's first window of a hash
            run = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
            common = np.bincount(run, new)[run] > COMMON
            for i, q in zip(item[common].tolist(), place[common].tolist()):
                covered[i][q : q + key[0]] = True
            sorted_[key] = h, item, place, common
        enough = np.array([c.sum() >= min(share * n, tokens) for c, n in zip(covered, sizes)], bool)
        tables, later = {}, {}
        for key, (h, item, place, common) in sorted_.items():
            wait = common & ~enough[item]
            order = np.flatnonzero(wait)[np.argsort(item[wait], kind="stable")]
            edges = np.flatnonzero(np.append(True, item[order][1:] != item[order][:-1])) if len(order) else []
            for own in np.split(order, edges[1:]) if len(order) else []:
                later.setdefault(int(item[own[0]]), []).append((key, h[own], place[own]))
            h, item, place = h[~wait], item[~wait], place[~wait]
            seen = np.zeros(1 << 22, bool)
            seen[(h >> np.uint64(42)).astype(np.int64)] = True
            tables[key] = (h, item, place, seen)
        return cls([i for i, _ in rows], sizes, [value[a:b] for a, b in spans], [kind[a:b] for a, b in spans], tables, later)


def _read_all(texts: list[str]):
    words = Words()
    parts = [words.read([t]) for t in texts]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    value, template, kind = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return value, template, kind, np.repeat(np.arange(len(texts)), [len(p[0]) for p in parts])


def consistent(mine: np.ndarray, theirs: np.ndarray) -> bool:
    """Whether the values of two rows of slots stand for each other, but for a few."""
    if not len(mine):
        return True
    pairs = Counter(zip(mine.tolist(), theirs.tolist()))
    most_left: dict = {}
    most_right: dict = {}
    for (a, b), _ in pairs.most_common():
        most_left.setdefault(a, b)
        most_right.setdefault(b, a)
    wrong = sum(n for (a, b), n in pairs.items() if most_left[a] != b or most_right[b] != a)
    return wrong <= CONFLICTS * len(mine)


def leaks(items: Items, texts: list[str], words: Words, share: float, tokens: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text number, item number, covered tokens, first and last token in the text, same slots)."""
    value, template, kind, doc = words.read(texts)
    hits: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = {}
    begin = np.searchsorted(doc, np.arange(len(texts) + 1))
    hashed = {}
    for (size, exact), (table, item, place, seen) in items.tables.items():
        h = hashed[size, exact] = windows(value if exact else template, size)
        at = np.flatnonzero(seen[(h >> np.uint64(42)).astype(np.int64)])
        at = at[doc[at] == doc[at + size - 1]]
        low, high = np.searchsorted(table, h[at], "left"), np.searchsorted(table, h[at], "right")
        for p, a, b in zip(at[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
            for k in range(a, b):
                by_diagonal = hits.setdefault((int(doc[p]), int(item[k])), {})
                by_diagonal.setdefault(p - int(place[k]), []).append((int(place[k]), size))
    for (d, i), diagonals in hits.items():
        for (size, exact), table, place in items.later.get(i, ()):
            own = hashed[size, exact][begin[d] : max(begin[d], begin[d + 1] - size + 1)]
            at = np.flatnonzero(np.isin(own, table))
            for p, a, b in zip((at + begin[d]).tolist(), np.searchsorted(table, own[at], "left").tolist(), np.searchsorted(table, own[at], "right").tolist()):
                for k in range(a, b):
                    diagonals.setdefault(p - int(place[k]), []).append((int(place[k]), size))
        covered = np.zeros(items.sizes[i], bool)
        first, last, same = 1 << 60, -1, True
        for shift, places in diagonals.items():
            region = np.zeros(items.sizes[i], bool)
            for q, size in places:
                region[q : q + size] = True
            own = np.flatnonzero(region)
            slots = own[(items.kinds[i][own] != PLAIN) & (kind[own + shift] != PLAIN)]
            mine, theirs = items.values[i][slots], value[slots + shift]
            if consistent(mine, theirs):
                covered |= region
                first, last = min(first, own[0] + shift), max(last, own[-1] + shift)
                same = same and np.array_equal(mine, theirs)
        n = int(covered.sum())
        if n and (n >= share * items.sizes[i] or n >= tokens):
            yield d, i, n, int(first - begin[d]), int(last - begin[d]), int(same)


LEAK = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("covered", T.IntegerType()),
        T.StructField("item_tokens", T.IntegerType()),
        T.StructField("first_token", T.IntegerType()),
        T.StructField("last_token", T.IntegerType()),
        T.StructField("same_slots", T.BooleanType()),
    ]
)


def mark(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, share: float = SHARE, tokens: int = TOKENS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows and columns, with `leaks`: the items that each whole text contains, by item_id.

    An item shorter than the window is one window; items of one token, or null, are in nothing. A
    null text leaks nothing. Equal items count once each; rows may repeat. The benchmark is sent to
    the tasks in blocks of bounded size, each of which every text is held against. A column named
    leaks is replaced.
    """
    spark = df.sparkSession
    rows = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("t")).filter("t IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-total // block_chars)
    kept = without(df, ["leaks"])
    out = kept.withColumn("leaks", F.array().cast(T.ArrayType(LEAK)))
    for b in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b).collect()
        index = spark.sparkContext.broadcast(Items.of(sorted((-1 if r["id"] is None else r["id"], r["t"]) for r in part), window, share, tokens))
        out = _with_leaks(out, kept.columns, text, index, share, tokens)
    return out


def _with_leaks(df: DataFrame, columns: list[str], text: str, index, share: float, tokens: int) -> DataFrame:
    source = df.select(F.col(f"`{text}`").alias("_text"), "leaks", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    schema = T.StructType([source.schema["_row"], T.StructField("leaks", T.ArrayType(LEAK))])

    def run(batches):
        words, items = Words(), index.value
        for batch in batches:
            for part in slices(batch, "_text", _SLICE):
                found = part["leaks"].to_pylist()
                for d, i, n, first, last, same in leaks(items, texts_of(part, "_text"), words, share, tokens):
                    found[d].append({"item_id": items.ids[i], "covered": n, "item_tokens": int(items.sizes[i]), "first_token": first, "last_token": last, "same_slots": bool(same)})
                found = [sorted(x, key=lambda r: (r["item_id"], r["first_token"])) for x in found]
                yield pa.RecordBatch.from_arrays([part["_row"], pa.array(found, part["leaks"].type)], names=["_row", "leaks"])

    return source.mapInArrow(run, schema).select(*[F.col(f"_row.`{c}`").alias(c) for c in columns], "leaks")
