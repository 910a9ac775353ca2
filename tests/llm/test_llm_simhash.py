"""SimHash fingerprints, links and components against brute force."""

import re
from itertools import combinations

import numpy as np
import xxhash

from tidemark.llm import simhash as S
from tidemark.llm.components import components


def fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(ids, values, most=3):
    f, parent = np.array(values, np.uint64), list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= most):
            parent[max(find(i), find(i + 1 + int(j)))] = min(find(i), find(i + 1 + int(j)))
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, d in enumerate(ids)}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near(seed, bases, copies, flips, bits=64):
    rng = np.random.default_rng(seed)
    out = []
    for base in rng.integers(0, 1 << 63, bases):
        for _ in range(copies):
            x = int(base)
            for b in rng.integers(0, bits, rng.integers(0, flips + 1)):
                x ^= 1 << int(b)
            out.append(x)
    return out


def test_postings_cover_every_choice_of_five():
    assert len(S.KEYS) == 14 and all(any(set(k) <= set(c) for k in S.KEYS) for c in combinations(range(8), 5))


def test_fingerprints_equal_the_plain_version(docs):
    texts = [None, "", " \t\n", "One", "two words", "A b C d E", "ÀÉ x y Z", "word " * 500, "a\x0bb\x0cc d", "One"]
    df = S.fingerprints(docs(texts, FINGERPRINT=1))
    assert len(df.columns) == 6
    for r in df.collect():
        assert r.fingerprint & (1 << 64) - 1 == fingerprint(texts[r.doc_id])


def test_components_equal_brute_force(spark):
    values = near(1, 30, 12, 6) + near(2, 1, 900, 8, bits=20) + [0, 0, 1, 7]
    ids = list(range(100, 100 + len(values)))
    df = spark.createDataFrame([(i, signed(v)) for i, v in zip(ids, values)], "doc_id long, fingerprint long")
    got = {r.doc_id: r.component_id for r in S.near_duplicates(df).collect()}
    assert got == least_reachable(ids, values)


def test_long_postings_are_split_and_searched_by_flips():
    f = np.unique(np.array(near(3, 1, 3000, 9, bits=22), np.uint64))
    pairs = S.linked(f[None, :400], 3)[0]
    flips = S.flipped(f[:400], 3)
    for label in (pairs, flips):
        own = least_reachable(range(400), f[:400].tolist())
        assert len(set(label.tolist())) == len(set(own.values()))
    assert (pairs == flips).all()


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 4), (3, None), (None, 5), (9, -1)], "doc_id long, fingerprint long")
    got = sorted((tuple(r) for r in S.near_duplicates(df).select("doc_id", "component_id").collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 3), (None, 1), (9, 9)], key=repr)
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    found = components(spark.createDataFrame(chain, "a long, b long"), "a", "b")
    got = {r.node: r.root for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_query_equals_brute_force(spark, tmp_path):
    from tidemark.llm.queries import QUERIES

    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, 60)) for _ in range(12)]
    texts = base + base[:5] + [b + " end" for b in base[:4]] + [b.upper() for b in base[6:8]] + ["", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    values = [fingerprint(t) for t in texts]
    want = least_reachable(range(len(texts)), values)
    for r in QUERIES["op10_simhash"](spark, str(tmp_path)).collect():
        assert (r.fingerprint, r.component_id) == (f"{values[r.doc_id]:016x}", want[r.doc_id])


def test_groups_over_several_fingerprints(spark):
    rows = [(0, 1 << 40, 5), (1, 1 << 40, 1 << 50), (2, 1 << 20 | 1 << 30 | 1 << 9, 1 << 50), (3, -1, -1)]
    df = spark.createDataFrame(rows, "row long, a long, b long")
    got = {r.row: r.group for r in S.groups(df, "row", ("a", "b")).collect()}
    assert got[0] == got[1] == got[2] == 0 and got[3] == 3
