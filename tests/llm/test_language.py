import itertools
import random

import numpy as np
import pytest

from mealmarts.llm import language as L


@pytest.fixture(scope="module")
def model(spark, docs):
    rng = random.Random(2)
    made = {"aa": "the of and to in is it".split(), "bb": "der die und das ist von zu".split(), "cc": "привет мир как дела".split()}
    rows = [(i, " ".join(rng.choice(made[k]) for _ in range(40)), k, "s") for i, k in enumerate(list(made) * 20)]
    return L.train(docs([*rows, (99, "unlabelled", None, "s"), (100, None, "aa", "s")]))


def test_spans_of_mixed_text(docs, model):
    text = "the of and it is to the und die das ist von der zu die привет мир"
    row = L.label(docs([(1, text)]), model).first()
    assert [(s.lang, text[s.start : s.stop]) for s in row.spans] == [
        ("aa", "the of and it is to the"), ("bb", "und die das ist von der zu die"), ("cc", "привет мир")
    ]
    assert row.lang_pred == "bb" and 0 < row.score < 1


def test_a_stray_word_does_not_switch(docs, model):
    row = L.label(docs([(1, "the of and it der is to the of and")]), model).first()
    assert len(row.spans) == 1 and row.lang_pred == "aa" and row.score == 1.0


def test_defined_results(docs, model, odd_rows):
    rows = L.label(docs([(1, None), (2, ""), (3, "12 34 !?"), (4, "the"), (4, "the"), (None, "die")]), model).collect()
    assert sorted([(r.doc_id or 0, r.lang_pred, r.score) for r in rows]) == [
        (0, "bb", 1.0), (1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "aa", 1.0), (4, "aa", 1.0)
    ]
    frame = docs(odd_rows).selectExpr("*", "1 as score", "2 as spans")
    assert L.label(frame, model).count() == len(odd_rows)
    assert L.label(frame.limit(0), model).count() == 0
    nothing = L.train(frame.limit(0))
    assert {r.lang_pred for r in L.label(frame, nothing).collect()} == {"und"}


def test_viterbi_finds_the_best_path():
    rng = np.random.RandomState(3)
    lengths = [4, 1, 0, 6, 3, 1]
    text = np.repeat(np.arange(6), lengths)
    scores = rng.normal(size=(len(text), 3)) * 3
    labels = L.viterbi(scores, text, 6, 2.0)

    def value(path, s):
        return sum(s[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

    for t, n in enumerate(lengths):
        s = scores[text == t]
        best = max((value(p, s) for p in itertools.product(range(3), repeat=n)), default=0)
        assert value(labels[text == t].tolist(), s) == pytest.approx(best)


def test_held_out_accuracy(spark):
    from mealmarts.llm import queries

    rows = queries.op2_language_spans(spark, "/root/testdata/sf0.001").filter("held_out").select("doc_id", "lang_pred")
    truth = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    pairs = rows.join(truth, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in pairs) >= 0.97 * len(pairs) > 0
