import random

from pyspark.sql import functions as F

from tidemark.llm import substrings


def plain(rows, words):
    """(doc_id, n_words, n_removed, kept) by comparing every window with every document's."""
    split = [(d, (t or "").encode().split()) for d, t in rows]
    holders = {}
    for d, w in split:
        for i in range(len(w) - words + 1):
            if d is not None:
                holders.setdefault(tuple(w[i : i + words]), []).append(d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - words + 1):
            if d is not None and min(holders[tuple(w[i : i + words])]) < d:
                gone.update(range(i, i + words))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((d, len(w), len(gone), kept))
    return sorted(out, key=repr)


def found(spark, rows, words=13):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("repeated", F.lit(1))
    cut = substrings.cut(df, words=words)
    assert cut.columns == ["doc_id", "text", "repeated", "n_words", "removed", "n_removed", "kept"]
    assert cut.filter("n_removed != aggregate(removed, 0L, (a, s) -> a + s.end - s.start)").isEmpty()
    return sorted(map(tuple, cut.select("doc_id", "n_words", "n_removed", "kept").collect()), key=repr)


def texts(count, seed=3):
    """Few words, so that short windows repeat often, and passages of all lengths that are shared."""
    make = random.Random(seed)
    shared = [[f"w{make.randrange(60)}" for _ in range(n)] for n in (5, 12, 13, 14, 25, 26, 27, 60)]
    out = []
    for _ in range(count):
        words = []
        for _ in range(make.randrange(6)):
            words += [f"w{make.randrange(60)}" for _ in range(make.randrange(12))] + make.choice(shared)
        out.append(" ".join(words))
    return out


def test_removed_words_equal_a_plain_comparison_of_all_windows(spark):
    rows = [(i * 7 % 200, t) for i, t in enumerate(texts(200))]
    for words in (3, 7, 8, 13, 14, 27):
        assert found(spark, rows, words) == plain(rows, words), words


def test_null_empty_and_repeated_rows_and_ids(spark):
    long = " ".join(f"x{i % 997}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, long), (5, long), (4, long + " y"), (None, long), (None, None), (6, "a b"), (-3, long[:500])]
    rows += [(7, "é " * 40), (8, "é é " * 40)]
    assert found(spark, rows) == plain(rows, 13)
    assert found(spark, []) == []


def test_a_window_in_every_document_goes_from_all_but_the_first(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    rows = [(i, f"{passage} own{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    kept = {r.doc_id: r.kept for r in substrings.cut(df).select("doc_id", "kept").collect()}
    assert kept == {i: (f"{passage} own0" if i == 0 else f"own{i}") for i in range(3000)}


def test_lengths_double_until_no_window_survives(spark):
    assert substrings.lengths(13) == [7, 13] and substrings.lengths(50) == [7, 13, 25, 50] and substrings.lengths(2) == [2]
    base = [f"b{i}" for i in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:60])), (3, " ".join(base[100:113])), (4, "z " * 50), (5, " ".join(base[40:200]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substrings.longest(df).collect())) == [(1, 104), (2, 52), (3, 13), (5, 104)]
    assert sorted(map(tuple, substrings.longest(df, words=4).collect())) == [(1, 128), (2, 32), (3, 8), (5, 128)]
    assert substrings.longest(df.limit(0)).isEmpty()
