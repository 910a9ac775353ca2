import hashlib
import math
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import importance

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = re.compile(rb"[A-Z]+")


def words_of(text):
    return WORD.findall(UPPER.sub(lambda m: m.group().lower(), (text or "").encode()))


def features_of(text):
    words = words_of(text)
    return [zlib.crc32(b" ".join(words[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target):
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features_of(text):
                counts[f] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (int(s.sum()) + 10000) / ((a + 1) * (int(t.sum()) + 10000)))) for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for doc_id, text in docs:
        found = features_of(text)
        weight, score = sum(gain[f] for f in found), None
        if doc_id is not None:
            h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words_of(text))])
    fit = sorted((r for r in rows if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0], r[2], r[1]))
    for place, row in enumerate(fit[: 30 * len(fit) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def drawn(spark, docs, target):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("clash")).withColumn("weight", F.lit("clash"))
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    gain = importance.gains(importance.bucket_counts(df), importance.bucket_counts(goal))
    found = importance.draw(importance.weigh(df, gain), (30, 100))
    assert found.columns == ["doc_id", "text", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_drawn_documents_equal_plain_spelling_of_every_feature(spark):
    texts = [" ".join(f"w{(i * j) % 37}" for j in range(15 + i % 20)) for i in range(60)]
    docs = list(enumerate(texts)) + [(100, None), (101, ""), (102, "..."), (103, "É" * 300 + " a " * 40), (104, "x" * 90_000 + " y z")]
    docs += [(None, texts[7] * 3), (5, texts[5]), (5, texts[40]), (7, texts[7]), (7, texts[7])]
    assert drawn(spark, docs, ["w1 w2 w3, W4 w5.", None, "w1 w1 w1"]) == plain(docs, ["w1 w2 w3, W4 w5.", None, "w1 w1 w1"])


def test_empty_tables_have_no_rows_and_an_empty_target_no_features(spark):
    assert drawn(spark, [], ["a b"]) == []
    docs = [(i, f"a b c d {i} " * 6) for i in range(10)]
    assert drawn(spark, docs, []) == plain(docs, [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 é.\n中", max_size=150), min_size=1, max_size=6))
def test_composed_payloads_equal_the_crc_of_the_spelled_run(texts):
    raw = [t.encode() for t in texts]
    words = importance.scan(raw)
    assert words.counts.tolist() == [len(words_of(t)) for t in texts]
    found = words.buckets(3, 10000)
    start = 0
    for text, count in zip(texts, words.counts.tolist()):
        got = [f for n, b in enumerate(found) for f in b[start : start + max(count - n, 0)].tolist()]
        assert got == features_of(text)
        start += count


def test_a_shift_of_any_length_joins_crcs():
    for n in (0, 1, 63, 64, 65, 127, 128, 1000, 65_537):
        tail = b"q" * n
        got = importance.shifted(np.array([zlib.crc32(b"head")], np.uint32), np.array([n])) ^ np.uint32(zlib.crc32(tail))
        assert int(got[0]) == zlib.crc32(b"head" + tail)
