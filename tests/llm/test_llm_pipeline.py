"""Line dedup, decontamination and the whole pipeline."""

import json

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tidemark.llm import decontaminate, line_templates
from tidemark.llm.queries import QUERIES

RNG = np.random.default_rng(11)
VOCABULARY = ["".join(RNG.choice(list("abcdefghijklmnop"), RNG.integers(2, 9))) for _ in range(3000)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


def document(seed, lines=4, words=15):
    return "\n".join(prose(words, seed * 100 + i) for i in range(lines))


# ------------------------------------------------------------------ lines


def dedup(docs, texts):
    return {r.doc_id: (r.text, r.dropped_lines) for r in line_templates.dedup(docs(texts, DROPPED_LINES=1)).collect()}


def test_passages_amid_different_lines_go_but_the_first_stays(docs):
    passage = prose(60, 1)
    texts = [f"{document(1)}\n{passage}\n{document(2)}", f"{passage}\n\n{document(3)}", f"{document(4)}\n{passage}", document(5)]
    got = dedup(docs, texts)
    assert got[0] == (texts[0], None) and got[3] == (texts[3], None)
    assert got[1] == (f"\n{document(3)}", [0]) and got[2] == (document(4), [4])


def test_variable_fields_are_one_template(docs):
    line = "report {} of the archive was written by {} on the {} day of march in town"
    fields = [("12", "ann", "3rd"), ("9", "ann", "21st"), ("77", "bob", "1st")]
    texts = [f"{document(i)}\n{line.format(*f)}\n{document(i + 50)}" for i, f in enumerate(fields)]
    got = dedup(docs, texts)
    assert got[0][1] is None and got[1][1] == [4] and got[2][1] == [4]


def test_passages_of_several_lines_go_wherever_they_stand(docs):
    passage = document(900, lines=3)
    texts = [f"{document(1)}\n{passage}\n{document(2)}", f"{passage}\n{document(3)}", f"{document(4)}\n{passage}", f"{document(5)}\n{passage}\n{document(6)}"]
    got = dedup(docs, texts)
    assert got[0] == (texts[0], None) and got[1] == (document(3), [0, 1, 2])
    assert got[2] == (document(4), [4, 5, 6]) and got[3] == (f"{document(5)}\n{document(6)}", [4, 5, 6])


def test_lines_too_short_to_go_still_tell_near_copies(docs):
    poem = "\n".join(prose(4, 7_000 + i) for i in range(6))
    texts = [f"{poem}\n{prose(20, 71)}\n{prose(4, 72)}", f"{poem}\n{prose(20, 71)}\n{prose(4, 73)}"]
    assert all(dropped is None for _, dropped in dedup(docs, texts).values())


def test_copies_are_left_to_document_dedup(docs):
    near = document(7).replace(" ", " x ", 1)
    texts = [document(6), document(6), document(7), near, "one line only here", "one line only here"]
    assert all(dropped is None for _, dropped in dedup(docs, texts).values())


def test_copies_of_the_first_document_stay_equal_to_it(docs):
    passage = prose(60, 1)
    whole = f"{document(1)}\n{passage}\n{document(2)}"
    got = dedup(docs, [whole, f"{document(3)}\n{passage}\n{document(4)}", whole])
    assert [got[i][1] for i in range(3)] == [None, [4], None]


def test_short_lines_need_more_documents(docs):
    texts = [f"{document(i)}\nAll rights reserved.\n{document(i + 60)}" for i in range(4)]
    assert all(d is None for _, d in dedup(docs, texts).values())
    got = dedup(docs, [*texts, f"{document(30)}\nAll rights reserved.\n{document(31)}"])
    assert [got[i][1] for i in range(5)] == [None, [4], [4], [4], [4]]


def test_odd_lines(docs, spark):
    texts = [None, "", "\n\n", " \t ", "a\r\nb", "x " * 50_000, document(1), document(1)]
    got = dedup(docs, texts)
    assert [got[i][0] for i in range(len(texts))] == texts
    assert line_templates.dedup(docs(["a"]).limit(0)).count() == 0
    passage = prose(60, 1)
    rows = [(None, f"{document(1)}\n{passage}\n{document(2)}"), (5, f"{document(3)}\n{passage}"), (5, f"{document(3)}\n{passage}")]
    df = line_templates.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((str(r.doc_id), r.dropped_lines) for r in df.collect()) == [("5", None), ("5", None), ("None", [4])]


# ------------------------------------------------------------------ decontamination


def leaks(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: [(x.item_id, x.covered, x.same_slots) for x in r.leaks] for r in decontaminate.mark(docs, bench).collect()}


QUESTION = "A train leaves the station with 24 passengers and Anna counts that 24 people pay 5 dollars each , how much does Anna collect before the train stops again"


def test_exact_and_reparameterised_questions(spark):
    again = QUESTION.replace("24", "36").replace("Anna", "Peter").replace("5 dollars", "7 euros")
    mixed = QUESTION.replace("24 passengers", "36 passengers").replace("24 people", "51 people").replace("counts that 24", "counts that 19")
    texts = [f"{prose(40, 1)}. {QUESTION}. {prose(40, 2)}", f"{prose(40, 3)}. {again} {prose(9, 4)}", prose(80, 5), QUESTION[:60], None, ""]
    got = leaks(spark, texts, [QUESTION, prose(30, 6), None, "one"])
    assert [x[0] for x in got[0]] == [0] and got[0][0][2] and [x[0] for x in got[1]] == [0] and not got[1][0][2]
    assert got[2] == got[3] == got[4] == got[5] == []
    assert decontaminate.consistent(np.array([1, 2, 1]), np.array([5, 6, 5])) and not decontaminate.consistent(np.array([1, 2, 1]), np.array([5, 6, 7]))
    assert mixed  # a value that stands for several values
    assert leaks(spark, [mixed], [QUESTION])[0] == [] or not leaks(spark, [mixed], [QUESTION])[0][0][2]


def test_items_of_mostly_slots_are_found_as_they_are_and_not_with_other_values(spark):
    numbers = " ".join(str(n * n + 7) for n in range(24))
    title = " ".join(w.capitalize() for w in prose(24, 60_000).split())
    mixed = f"{prose(12, 60_001)} {' '.join(str(n * 3 + 1000) for n in range(16))}"
    items = [numbers, title, mixed, "17 19 23"]
    texts = [f"{prose(20, 60_010 + i)} {x} {prose(20, 60_020 + i)}" for i, x in enumerate(items)]
    texts += [" ".join(str(n * n + 8) for n in range(24)), " ".join(w.capitalize() for w in prose(24, 60_002).split())]
    got = leaks(spark, texts, items)
    assert [got[i] for i in range(4)] == [[(0, 24, True)], [(1, 24, True)], [(2, 28, True)], [(3, 3, True)]]
    assert got[4] == got[5] == []


def test_against_containment(spark):
    items = [prose(30 + i, 50_000 + i) for i in range(20)]
    texts = [f"{document(i)} {items[i]} {document(i + 300)}" if i % 2 else document(i) for i in range(20)] + [items[4], items[4]]
    got = leaks(spark, texts, items + [items[4]])
    want = {d: sorted({i for i, x in enumerate(items + [items[4]]) if x in t}) for d, t in enumerate(texts)}
    assert {d: sorted(x[0] for x in v) for d, v in got.items()} == want


def test_windows_that_many_items_share_lose_no_leak(monkeypatch):
    opening = "answer the following question about the text and give reasons"
    make = np.random.default_rng(4)
    items = [(i, f"{opening} {prose(int(make.integers(0, 30)), i)}" + (f" {opening}" if i % 9 == 0 else "")) for i in range(120)]
    texts = [f"{prose(40, 1000 + i)} {items[i % 120][1] if i % 3 else opening} {prose(10, 2000 + i)}" for i in range(90)]
    texts += [opening, f"{opening} {opening}", " ".join(items[5][1].split()[4:]), ""]

    def found():
        held = decontaminate.Items.of(items, decontaminate.WINDOW)
        return held, sorted(decontaminate.leaks(held, texts, decontaminate.Words(), decontaminate.SHARE, decontaminate.TOKENS))

    held, fast = found()
    assert len(held.later) > 60
    monkeypatch.setattr(decontaminate, "COMMON", 1 << 40)
    held, slow = found()
    assert not held.later and fast == slow and len(fast) > 60


def test_benchmark_in_blocks_and_empty(spark):
    items = [prose(30, 400 + i) for i in range(12)]
    docs = spark.createDataFrame([(i, f"{prose(20, i)} {t}", 1) for i, t in enumerate(items)], "doc_id long, text string, LEAKS int")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.mark(docs, bench, block_chars=500).collect()
    assert all([x.item_id for x in r.leaks] == [r.doc_id] for r in got) and len(got) == 12
    assert all(r.leaks == [] for r in decontaminate.mark(docs, bench.limit(0)).collect())
    assert decontaminate.mark(docs.limit(0), bench).count() == 0


# ------------------------------------------------------------------ pipeline


@pytest.fixture
def tables(spark, tmp_path):
    passage = prose(60, 999)
    texts = [document(i) for i in range(40)]
    texts += [texts[3], texts[3], texts[4].upper()]  # copies: 40, 41, 42
    texts += [f"{document(60)}\n{passage}\n{document(61)}", f"{document(62)}\n{passage}\n{document(63)}"]  # 43, 44
    item = prose(40, 777)
    texts += [f"{document(70)} {item} {document(71)}"]  # 45
    texts += ["", None, "12345 67890", texts[0]]  # 46, 47, 48, 49
    rows = [(i, t, "en" if i % 4 else "fr", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), texts, passage


def test_stages_take_effect(spark, tables):
    folder, texts, passage = tables
    out = corpus_pipeline.run(spark, folder)
    rows = {r.doc_id: r for r in out.collect()}
    clean = set(range(40)) | {43, 44}
    assert set(rows) == clean
    assert sum(passage in r.text for r in rows.values()) == 1 and passage in rows[43].text
    for r in rows.values():
        assert r.round_trip and r.n_tokens == len(r.ids)
        if r.doc_id != 44:
            assert r.text == texts[r.doc_id]
    assert rows[44].n_chars == len(rows[44].text)


def test_every_stage_keeps_the_columns_and_takes_odd_rows(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.union(docs.filter("doc_id in (1, 47)")).selectExpr(*[f"{c}" if c != "doc_id" else "nullif(doc_id, 2) AS doc_id" for c in docs.columns])
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for df in (odd, docs.limit(0)):
            out = stage(spark, df, folder)
            assert out.columns[: len(docs.columns)] == docs.columns
            assert out.count() <= df.count()
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns


def test_queries_are_registered():
    names = [n for n in QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in QUERIES
    assert json.dumps(names) and public_tokenizers.path("byte_bpe_50k.json")
