"""Operators beyond SQL against plain versions, and rows that once broke them."""

import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, line_templates, nearest, quality

# ------------------------------------------------------------------ lines


def plain_dedup(rows):
    """(doc_id, dropped lines) by looking at every template of every line in one place."""
    parsed = []
    for doc_id, text in rows:
        lines = [(n, *line_templates.parse(x)) for n, x in enumerate((text or "").split("\n")) if x.strip()]
        parsed.append((doc_id, text, lines))
    seen = {}
    for doc_id, text, lines in parsed:
        leaves = [x[2] for x in lines]
        for j, (n, size, _, templates) in enumerate(lines):
            before = leaves[j - 1] if j else (leaves[1] if len(leaves) > 1 else 0)
            after = leaves[j + 1] if j + 1 < len(leaves) else (leaves[j - 1] if j else 0)
            for t in templates:
                seen.setdefault(t, []).append((doc_id, text, len(lines), n, size, before, after))
    gone = {}
    shared = {}
    for t, held in seen.items():
        documents = len({(d, x) for d, x, *_ in held})
        if documents < 2:
            continue
        first = min((d, x, k) for d, x, k, *_ in held)
        enough = documents >= (5 if min(h[4] for h in held) < line_templates.SHORT else 2)
        apart = len({h[5] for h in held}) > 1 and len({h[6] for h in held}) > 1
        for d, x, k, n, *_ in held:
            if d != first[0] and x != first[1]:
                common, found, lone = shared.setdefault((d, x, k, first), (set(), set(), set()))
                common.add(n)
                found |= {n} if enough else set()
                lone |= {n} if enough and apart else set()
    for (d, x, k, first), (common, found, lone) in shared.items():
        gone.setdefault((d, x), set()).update(lone if len(common) * 2 > max(k, first[2]) else found)
    return {d: sorted(gone.get((d, x), ())) or None for d, x in rows}


def test_dropped_lines_equal_a_plain_look_at_all_templates(docs):
    make = random.Random(5)
    pool = [" ".join(f"w{chr(97 + make.randrange(20))}{chr(97 + make.randrange(20))}" for _ in range(make.choice((3, 6, 9, 14)))) + f" {i % 7}" for i in range(40)]
    texts = []
    for i in range(120):
        lines = [make.choice(pool) if make.random() < 0.4 else f"own {i} line {j} " + " ".join(make.choice("abcdefgh") * 3 for _ in range(9)) for j in range(make.randrange(1, 7))]
        texts.append("\n".join(lines))
    texts += [texts[3] + "\n" + pool[0], texts[3], None, "", "\n\n"]
    found = {r.doc_id: r.dropped_lines for r in line_templates.dedup(docs(texts)).collect()}
    assert found == plain_dedup(list(enumerate(texts))) and sum(v is not None for v in found.values()) > 20


# ------------------------------------------------------------------ languages

SPANISH = ["el perro come la comida de la casa y bebe agua", "los ninos juegan en la calle con una pelota roja", "manana iremos al mercado para comprar frutas"]


def plain_counts(text):
    """n-gram to count, spelled out."""
    letters = "".join(c if unicodedata.category(c).startswith("L") else " " for c in text.lower())
    run = re.sub(" +", " ", letters + " ")
    out = {}
    for n in (1, 2, 3):
        for i in range(len(run) - n + 1):
            gram = run[i : i + n]
            if n > 1 or gram != " ":
                out[gram] = out.get(gram, 0) + 1
    return out if letters.strip() else {}


def test_languages_equal_a_plain_nearest_centroid(spark):
    english = [f"the {a} dog number {i} runs over the green hill and eats {a} food" for i, a in enumerate(["big", "small", "old", "red"] * 10)]
    rows = [(i, t, "en") for i, t in enumerate(english)] + [(100 + i, f"{t} {'y otra cosa ' * (i % 4)}", "es") for i, t in enumerate(SPANISH * 10)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["a dog eats", "la comida roja", "", "123", "El Perro!", "the red la calle", "ñandú 中文", *SPANISH, *english[:5]]
    found, score, _ = model.predict(texts)
    for text, lang, got in zip(texts, found, score):
        weight = {}
        for gram, count in plain_counts(text).items():
            code = 0
            for c in gram:
                code = (code * 0x110000 + ord(c)) % (1 << 64)
            at = (code * 0x9E3779B97F4A7C15 % (1 << 64)) >> 52
            weight[at] = weight.get(at, 0) + count
        if not weight:
            assert (lang, got) == ("und", 0)
            continue
        vector = {k: np.log1p(v) * float(model.idf[k]) for k, v in weight.items()}
        norm = np.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(v * float(c[k]) for k, v in vector.items()) / norm for c in model.centres]
        assert got == pytest.approx(max(cosines), abs=1e-4), text
        assert lang == model.languages[int(np.argmax(cosines))], text


def test_a_language_of_few_texts_in_many_rows_is_learned(spark):
    base = spark.range(60_000).select(F.element_at(F.array(*map(F.lit, SPANISH)), (F.col("id") % 3 + 1).cast("int")).alias("text"), F.lit("es").alias("lang"))
    english = spark.createDataFrame([(f"the dog number {chr(97 + i % 26)}{chr(97 + i // 26)} runs over the hill", "en") for i in range(100)], "text string, lang string")
    for twist in ("", " ay", " oh no"):
        model = language_id.fit(base.withColumn("text", F.concat("text", F.lit(twist))).unionByName(english))
        assert set(model.languages) == {"en", "es"}
        assert model.predict([SPANISH[0] + twist])[0] == ["es"]


def test_very_many_short_texts_are_counted_in_parts(spark):
    rows = [("hello world this is", "en"), ("hola mundo esto es", "es")] * 20
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    found, score, rejected = model.predict(["hola", "hello", ""] * 2000)
    assert found == ["es", "en", "und"] * 2000 and len(score) == len(rejected) == 6000


# ------------------------------------------------------------------ vectors


def test_repeated_rows_of_one_id_can_be_searched(spark):
    df = spark.range(30_000).select(F.lit(40).cast("long").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    other = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 6)], "vec_id long, embedding array<double>")
    for lists in (nearest.LISTS, 1):
        found = nearest.search(df.unionByName(other), F.col("vec_id") == 2, 3, lists=lists).collect()
        assert [r.rank for r in found] == [1, 2, 3] and (found[0].vec_id, found[0].score) == (5, 11.0)
    assert [(r.vec_id, r.score) for r in found] == [(5, 11.0), (4, 9.0), (3, 7.0)]
    assert nearest.search(df, F.col("vec_id") == 40, 3).isEmpty()  # nothing but the query's own id


def test_one_list_is_exact_whatever_the_table(spark):
    make = np.random.default_rng(1)
    x = make.standard_normal((3000, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    scores = x[:5] @ x.T
    np.fill_diagonal(scores, -np.inf)
    want = {(i, int(j)) for i in range(5) for j in np.argsort(-scores[i], kind="stable")[:10]}
    for options in ({"lists": 1}, {"one_list": 10_000}):
        found = {(r.query_id, r.vec_id) for r in nearest.search(df, F.col("vec_id") < 5, 10, **options).collect()}
        assert len(found & want) >= 0.97 * len(want)


# ------------------------------------------------------------------ quality


def test_scores_replace_a_clashing_column_and_null_features_have_none(spark, docs):
    df = quality.features(docs(["one two three.", "x " * 50, None, "abc def"], score="clash"))
    labelled = df.withColumn("quality", (F.col("doc_id") % 2).cast("int"))
    model = quality.fit(labelled.withColumn("features", F.when(F.col("doc_id") != 3, F.col("features"))))
    odd = df.withColumn("features", F.when(F.col("doc_id") != 1, F.col("features")))
    scored = quality.score(odd, model)
    assert scored.columns.count("score") == 1
    got = {r.doc_id: r.score for r in scored.collect()}
    assert got[1] is None and all(0 <= got[i] <= 1 for i in (0, 2, 3))
    assert quality.score(df.limit(0), model).count() == 0
