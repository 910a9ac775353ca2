"""SimHash fingerprints and their near duplicates, by an inverted index of byte positions.

Two fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so at least 5
positional bytes are shared. The index has a posting for every four positions whose numbers XOR to
zero; there are 14 such sets, and any 5 positions contain one of them. In a posting the shared
positional bytes of a pair are tallied, pairs below 5 are dropped and the others verified bit by
bit. A posting that is too long for pairs is split by each further position: a pair with 5 shared
bytes meets again there, and such a part can't hold more fingerprints than three bytes have values.
Long parts look their neighbours up by flipping up to 3 of the 24 free bits instead of by pairs.
Each posting passes on only what links its members, at most one link per member.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, bytes_of, mapped, stored
from tidemark.llm.components import components

SEED = 42
POSITIONS = 8
MOST_BITS = 3
SHARED = POSITIONS - MOST_BITS
#: longest posting whose pairs are tallied; longer ones are split or searched by flipped bits
PAIRED = 512
_SLICE = 8_000_000
_CELLS = 4_000_000
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_AT = (np.arange(POSITIONS) * 256)[None, :]

_MIX = np.uint64(0xBF58476D1CE4E5B9)
KEYS = [k for k in combinations(range(POSITIONS), SHARED - 1) if np.bitwise_xor.reduce(k) == 0]


def mask(positions) -> int:
    """The bits of the bytes at some positions, as a signed 64-bit number."""
    bits = sum(0xFF << (8 * p) for p in positions)
    return bits - (1 << 64) if bits >> 63 else bits


def shingle_hashes(text: bytes, words_each: int) -> list[int]:
    words = text.translate(LOWER).split()
    if not words:
        return []
    if len(words) < words_each:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - words_each + 1].tolist(), ends[words_each - 1 :].tolist())
    return [digest(joined[a:b], SEED) for a, b in spans]


def fingerprint(text: bytes, words_each: int, variants: int = 1) -> list[int]:
    """A bit is 1 if it is set in over half of the shingles' hashes; more variants mix these anew."""
    hashes = np.array(shingle_hashes(text, words_each), np.uint64)
    if not len(hashes):
        return [0] * variants
    out = []
    for v in range(variants):
        if v:
            hashes = (hashes ^ (hashes >> np.uint64(29))) * _MIX
        raw = (hashes ^ (hashes >> np.uint64(32)) if v else hashes).view(np.uint8).reshape(-1, POSITIONS)
        tally = np.bincount((raw + _AT).ravel(), minlength=256 * POSITIONS).reshape(POSITIONS, 256) @ _BITS
        out.append(int(np.packbits(tally * 2 > len(hashes), bitorder="little").view(np.uint64)[0]))
    return out


def fingerprints(df: DataFrame, text: str = "text", words_each: int = 3, out: tuple[str, ...] = ("fingerprint",)) -> DataFrame:
    """All rows and columns, with a 64-bit fingerprint of each whole text as a signed long; with
    more names in `out`, as many fingerprints from independent mixtures of the hashes.

    Texts without a word, or null, get 0. Columns with these names are replaced.
    """

    def run(part):
        found = [fingerprint(t, words_each, len(out)) for t in bytes_of(part, "_text")]
        return [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in np.array(found, np.uint64).reshape(-1, len(out)).T]

    return mapped(df, text, _SLICE, dict.fromkeys(out, "long"), run)


# ------------------------------------------------------------------------------ links


def linked(f: np.ndarray, most: int) -> np.ndarray:
    """For groups of equally many fingerprints, a row each: the least linked place in the group."""
    g, s = f.shape
    x = f[:, :, None] ^ f[:, None, :]
    shared = np.zeros(x.shape, np.uint8)
    for p in range(POSITIONS):
        shared += (x >> np.uint64(8 * p)) & np.uint64(0xFF) == 0
    near = (shared >= POSITIONS - most) & (np.bitwise_count(x) <= most)
    label = np.broadcast_to(np.arange(s), (g, s))
    while True:
        new = np.where(near, label[:, None, :], s).min(axis=2)
        if np.array_equal(new, label):
            return label
        label = new


def flipped(f: np.ndarray, most: int) -> np.ndarray:
    """The same for one long group whose members differ in few bits: neighbours by flipped bits."""
    differ = int(np.bitwise_or.reduce(f ^ f[0]))
    free = [b for b in range(64) if differ >> b & 1]
    value = np.zeros(len(f), np.int64)
    for i, b in enumerate(free):
        value |= ((f >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    order = np.argsort(value)
    ranked = value[order]
    flips = [sum(1 << i for i in c) for n in range(1, most + 1) for c in combinations(range(len(free)), n)]
    label = np.arange(len(f))  # by rank
    while True:
        new = label.copy()
        for flip in flips:
            want = ranked ^ flip
            at = np.minimum(np.searchsorted(ranked, want), len(f) - 1)
            np.minimum(new, np.where(ranked[at] == want, label[at], new), out=new)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    out = np.empty(len(f), np.int64)
    out[order] = order[label]
    return out


def _forest(f: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int):
    """Links (a, b) that connect what is linked inside groups of consecutive fingerprints."""
    for size in np.unique(sizes[sizes > 1]):
        at = starts[sizes == size]
        if size > PAIRED:
            for a in at:
                group = f[a : a + size]
                label = flipped(group, most)
                own = np.flatnonzero(label != np.arange(size))
                yield group[own], group[label[own]]
            continue
        step = max(1, _CELLS // int(size * size))
        for i in range(0, len(at), step):
            groups = f[at[i : i + step, None] + np.arange(size)]
            label = linked(groups, most)
            g, own = np.nonzero(label != np.arange(size))
            yield groups[g, own], groups[g, label[g, own]]


def _scan(most: int, split: bool):
    """Goes through rows sorted by posting. Rows out: a and b of a link, or, if `split`, the posting
    (in `key`) and member (in `a`) of one that is too long."""

    def rows(key, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int32()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["key", "a", "b"]
        )

    def run(batches):
        key, held, f = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in _then_none(batches):
            if batch is not None:
                key = np.concatenate((key, batch["key"].to_numpy()))
                held = np.concatenate((held, batch["held"].to_numpy()))
                f = np.concatenate((f, batch["f"].to_numpy().view(np.uint64)))
            if not len(f):
                continue
            new = np.flatnonzero((key[1:] != key[:-1]) | (held[1:] != held[:-1])) + 1
            starts = np.concatenate(([0], new))
            sizes = np.diff(np.append(starts, len(f)))
            if batch is not None:  # the last posting may go on
                keep = starts[-1]
                starts, sizes = starts[:-1], sizes[:-1]
            else:
                keep = len(f)
            if split and len(f) - keep > 50 * PAIRED:
                # too long already: its rows go on, the last few stay so that the rest does as well
                part = slice(keep, len(f) - PAIRED - 1)
                yield rows(key[part], f[part], f[part])
                key, held, f = (np.concatenate((x[:keep], x[part.stop :])) for x in (key, held, f))
            if split:
                for a, n in zip(starts[sizes > PAIRED], sizes[sizes > PAIRED]):
                    yield rows(key[a : a + n], f[a : a + n], f[a : a + n])
                starts, sizes = starts[sizes <= PAIRED], sizes[sizes <= PAIRED]
            for a, b in _forest(f, starts, sizes, most):
                yield rows(np.full(len(a), -1), a, b)
            key, held, f = key[keep:], held[keep:], f[keep:]

    return run


def _then_none(batches):
    yield from batches
    yield None


_ROWS = "key int, a long, b long"


def links(df: DataFrame, column: str = "fingerprint", most: int = MOST_BITS) -> DataFrame:
    """Pairs (a, b) of different fingerprints that connect all those within `most` (0 to 3) bits."""
    if not 0 <= most <= MOST_BITS:
        raise ValueError(f"the index guarantees up to {MOST_BITS} bits")
    f = F.col("f")
    different = df.select(F.col(column).alias("f")).filter("f is not null").distinct()
    postings = F.array(*[F.struct(F.lit(i).alias("key"), f.bitwiseAND(F.lit(mask(k))).alias("held")) for i, k in enumerate(KEYS)])
    index = different.select(F.explode(postings).alias("p"), "f").select("p.key", "p.held", "f")
    first = stored(_by_posting(index).mapInArrow(_scan(most, True), _ROWS), "simhash")
    # of a long posting: 14 sets of positions times 8 further ones
    parts = [
        F.when(F.col("key") == i, F.array(*[F.struct(F.lit(len(KEYS) + i * POSITIONS + p).alias("key"), f.bitwiseAND(F.lit(mask((*k, p)))).alias("held")) for p in range(POSITIONS) if p not in k]))
        for i, k in enumerate(KEYS)
    ]
    again = first.filter("key >= 0").select("key", F.col("a").alias("f")).select(F.explode(F.coalesce(*parts)).alias("p"), "f").select("p.key", "p.held", "f")
    second = _by_posting(again).mapInArrow(_scan(most, False), _ROWS)
    return first.filter("key < 0").unionByName(second).select("a", "b")


def _by_posting(index: DataFrame) -> DataFrame:
    return index.repartition("key", "held").sortWithinPartitions("key", "held")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", fingerprint: str = "fingerprint", most: int = MOST_BITS, out: str = "component_id") -> DataFrame:
    """All rows and columns, with the smallest id that is reachable over links, its own included.

    df must be stored or cheap to read again. Equal fingerprints are linked. Rows with a null
    fingerprint are linked to nothing; null ids are never the smallest unless all are null.
    """
    nodes = components(links(df, fingerprint, most), "a", "b")
    least = df.groupBy(F.col(fingerprint).alias("node")).agg(F.min(doc_id).alias("least"))
    rooted = least.join(nodes, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    whole = rooted.filter("node is not null").groupBy("root").agg(F.min("least").alias(out))
    known = rooted.join(whole, "root").select("node", out)
    joined = df.join(known, df[fingerprint] == known["node"], "left")
    return joined.select(*[df[c] for c in df.columns if c != out], F.when(F.col("node").isNull(), df[doc_id]).otherwise(F.col(out)).alias(out))


def groups(df: DataFrame, node: str, columns: tuple[str, ...], most: int = MOST_BITS, out: str = "group") -> DataFrame:
    """(node, out) of each row: the smallest node reachable over links of any of the fingerprints.

    node must be different for each row and not null. df must be stored.
    """
    edges = []
    for c in columns:
        first = df.groupBy(F.col(c).alias("f")).agg(F.min(node).alias("first"))
        edges.append(df.join(first, df[c] == first["f"]).filter(F.col(node) != F.col("first")).select(F.col(node).alias("a"), F.col("first").alias("b")))
        found = links(df, c, most)
        ends = [first.select(F.col("f").alias(x), F.col("first").alias(f"first_{x}")) for x in ("a", "b")]
        edges.append(found.join(ends[0], "a").join(ends[1], "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b")))
    found = components(reduce(DataFrame.unionByName, edges), "a", "b")
    joined = df.select(node).join(found, df[node] == found["node"], "left")
    return joined.select(df[node], F.coalesce("root", df[node]).alias(out))
