import random
import zlib

import numpy as np
import pytest
import zstandard

from mealmarts.llm import compression as C
from tests.llm.conftest import sentence

LABELS = "doc_id long, quality int, text string, label string, part int"


def made(n=400, seed=2):
    """Prose, against prose with a sign after every word, capitals, and repeated words; a quarter is bad."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text, bad = sentence(rng, rng.randint(30, 200), "abcdeorst"), i % 4 == 0
        if bad:
            kind = i // 4 % 3
            text = " ".join(w + rng.choice(["###", "%%%", "&&&"]) for w in text.split()) if kind == 0 else text
            text = text.upper() if kind == 1 else text
            text = " ".join([text.split()[0]] * 100) if kind == 2 else text
        rows.append((i, text, int(not bad)))
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(d, q, "x", "y", 3) for d, q in rows], LABELS)


@pytest.fixture(scope="module")
def learned(spark, docs):
    rows = [r for r in made() if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    return C.train(docs([r[:2] for r in rows]), labels(spark, [(r[0], r[2]) for r in rows]))


def test_held_out_documents(docs, learned):
    rows = [r for r in made() if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    scores = {r.doc_id: r.score for r in C.score(docs([r[:2] for r in rows]), learned).collect()}
    right = [(scores[d] >= 0.7) == bool(q) for d, _, q in rows]
    assert len(right) > 80 and sum(right) / len(right) >= 0.95
    assert all(0 <= s <= 1 for s in scores.values())


def test_sizes_by_the_library_and_blocks(docs, learned, odd_rows):
    """Sizes of whole texts equal a plain recount, and scores follow from them."""
    text = {}
    for doc, t in odd_rows:
        text.setdefault(doc, []).append(t)
    for r in C.score(docs(odd_rows), learned).collect():
        candidates = []
        for t in text[r.doc_id]:
            data, found = (t or "").encode(), []
            for name, pair in zip(C.VIEWS, learned.dictionaries):
                seen = C.view(data, name)
                for d in pair:
                    z = zstandard.ZstdCompressor(
                        level=C.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False
                    )
                    found.append(sum(len(z.compress(seen[i : i + C.BLOCK])) for i in range(0, max(1, len(seen)), C.BLOCK)))
            x = C.features(np.array([float(len(data))]), np.array([found], float))
            p = C._sigmoid(np.c_[(x - learned.centre) / learned.scale, [1.0]] @ learned.weights)[0]
            candidates.append((len(data), found, round(p, 9)))
        assert (r.n_bytes, r.sizes, round(r.score, 9)) in candidates


def test_shape_keeps_signs_and_classes():
    assert C.view("Añ 9% é|".encode(), "shape") == b"Aaa 0% aa|"


def test_same_model_twice_and_whatever_the_partitions(spark, docs, learned):
    rows = [r for r in made() if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    again = C.train(docs([r[:2] for r in rows[::-1]]).repartition(7), labels(spark, [(r[0], r[2]) for r in rows[::-1]]))
    assert np.allclose(again.weights, learned.weights, atol=1e-6)


def test_odd_labels_and_tables(spark, docs):
    rows = made(60)
    table = docs([r[:2] for r in rows] + [(None, "x"), (5, None)])
    for marks, want in (([], 0.5), ([(1, 1), (2, 1), (None, 0), (4, 7)], 1.0), ([(0, 0), (1, None)], 0.0)):
        model = C.train(table, labels(spark, marks))
        assert {r.score for r in C.score(table, model).collect()} == {want}
    few = C.train(table, labels(spark, [(0, 0), (0, 1), (1, 1), (1, 1), (999, 0)]))  # too little to train a dictionary
    scored = C.score(table, few).collect()
    assert len(scored) == 62 and all(0 <= r.score <= 1 for r in scored)
    assert C.score(docs(rows[:0]), few).collect() == []
    assert C.train(docs(rows[:0]), labels(spark, [(1, 1), (2, 0)])).fixed is not None


def test_long_text_in_blocks(docs, learned):
    """A junk text of several megabytes is as bad as its start."""
    junk = " ".join(w + "###" for w in sentence(random.Random(8), 4000).split())
    found = {r.doc_id: r.score for r in C.score(docs([(1, junk), (2, junk * 60)]), learned).collect()}
    assert found[1] < 0.7 and found[2] < 0.7
