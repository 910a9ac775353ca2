"""Token counts and byte-level BPE against the libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import regex
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, pretokens, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
BITS = ["'", "s", "t", "re", "ll", "'ll", "'ve", " ", "  ", "\n", "\t", "a", "the", " of", "B", "é", "1", "²", "!", "$",
        "　", "字", "é", "😀", "\x1c", "\x85", "<|endoftext|>", "<|endo"]


def texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 10))) for _ in range(n)]


def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pretokens_equal_the_pattern():
    pattern, some = regex.compile(P.PATTERN), texts(3000)
    pieces, _, counts = pretokens.split(some)
    want = [pattern.findall(t) for t in some]
    assert pieces == sum(want, []) and counts.tolist() == [len(w) for w in want]


def test_counts_at_every_prefix_equal_the_library():
    counter, own = Tokenizer.from_file(JSON), token_counts.Prefixes(JSON)
    for text in texts(300, 1):
        got = np.frombuffer(own.deltas([text])[0], np.int8).cumsum().tolist()
        assert got == [len(counter.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)], text


def test_prefix_counts_answer_budgets(docs):
    counter = Tokenizer.from_file(JSON)
    some = [None, "", "word " * 400, "a<|endoftext|>b", *texts(20, 2), "word " * 400]
    df = token_counts.prefix_counts(docs(some, N_TOKENS=7), JSON)
    assert [c for c in df.columns if c.lower() == "n_tokens"] == ["n_tokens"]
    rows = token_counts.within_budget(df, 5).withColumn("three", token_counts.count_at(3)).orderBy("doc_id").collect()
    assert len(rows) == len(some)
    count = lambda t: len(counter.encode(t, add_special_tokens=False).ids)
    for r in rows:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens, r.three) == (len(text.encode()), count(text), count(text[:3]))
        fits = [k for k in range(len(text) + 1) if count(text[:k]) <= 5]
        assert r.fit_chars == max(fits)


def test_empty_table(docs):
    none = docs(["x"]).limit(0)
    assert token_counts.prefix_counts(none, JSON).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(none, RANKS), RANKS).count() == 0


def test_chunks_are_stitched_like_the_whole(docs):
    enc, rng = library(), random.Random(3)
    some = ["".join(rng.choice(BITS) for _ in range(rng.randint(20, 300))) for _ in range(60)]
    some += ["a" * 900, " " * 700 + "x", "'" * 500, "1" * 333 + "é" * 333, None, "", "short", "a" * 900]
    df = byte_bpe.encode(docs(some, ids="old"), RANKS, chunk=40, overlap=6)
    assert df.columns.count("ids") == 1
    rows = byte_bpe.decode(df, RANKS).orderBy("doc_id").collect()
    assert len(rows) == len(some)
    for r, text in zip(rows, some):
        assert r.ids == enc.encode_ordinary(text or ""), text
        assert bytes(r.decoded) == (text or "").encode() and r.text == text and r.source == "s"


def test_stitching_goes_on_where_an_overlap_has_no_boundary():
    text = "x" * 100 + " " + "y" * 100
    step, overlap = 30, 5
    starts = range(0, len(text) - overlap, step)
    chunks = [text[s : s + step + overlap] if s != starts[-1] else text[s:] for s in starts]
    ends = [byte_bpe.sure_ends(c, s == starts[-1]) for c, s in zip(chunks, starts)]
    whole, cuts = byte_bpe.stitched(chunks, ends, step)
    assert whole == text and cuts.tolist() == [100, 201]


def test_queries_on_a_fixture(spark, tmp_path):
    from tidemark.llm.queries import QUERIES

    some = [None, "", "Hello  world\n", "don't stop", "é" * 50]
    spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    enc = library()
    for r in QUERIES["op5_byte_bpe"](spark, str(tmp_path)).collect():
        ids = enc.encode_ordinary(some[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((some[r.doc_id] or "").encode()).hexdigest()
    counter = Tokenizer.from_file(JSON)
    for r in QUERIES["op1_token_counts"](spark, str(tmp_path)).collect():
        assert r.n_tokens == len(counter.encode(some[r.doc_id] or "", add_special_tokens=False).ids) and not r.over_limit
