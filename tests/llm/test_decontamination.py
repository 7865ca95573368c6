import random

import numpy as np
import pytest

from mealmarts.llm import decontamination as D


@pytest.fixture(scope="module")
def tables(spark, docs):
    rng = random.Random(9)
    fresh = lambda n: " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    items = [(i, fresh(rng.choice([5, 9, 20, 40, 120, 700]))) for i in range(30)] + [(30, None), (31, ""), (32, "too short item"), (None, fresh(12))]
    items += [(33, items[0][1])]
    rows = [(i, fresh(300)) for i in range(20)]
    for i, (_, text) in enumerate(items):
        if text:
            w = text.upper().split()
            broken = [*w]
            for _ in range(len(w) // 25 + 1):
                broken[rng.randrange(len(w))] = "EDIT"
            rows.append((100 + i, f"{fresh(400)} {' '.join(w)} {fresh(400)}"))
            rows.append((200 + i, f"{fresh(3000)}\n{' '.join(broken)}\t{fresh(30)}"))
    rows += [(300, None), (301, ""), (None, items[3][1]), (302, items[3][1]), (302, items[3][1])]
    return rows, items


def brute(rows, items):
    out = []
    for doc, text in rows:
        held = D.shingles(text)
        for item, own in items:
            own = D.shingles(own)
            if own and len(own & held) >= 0.8 * len(own):
                out.append((doc, item, len(own & held), len(own)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [D.SMALL, 0])
def test_all_leaks_by_either_way(spark, docs, tables, small):
    rows, items = tables
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as sketch")
    got = sorted([tuple(r) for r in D.leaks(docs(rows), frame, small=small).collect()], key=repr)
    assert got == brute(rows, items) and len(got) > 50


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(docs([(1, "a b c d e f")]), none).count() == 0
    assert D.leaks(docs([(1, "x")]).limit(0), spark.createDataFrame([(1, "a b c d e f")], none.schema)).count() == 0


def test_sketch_holds_least_hashes_of_the_set():
    values = np.unique(np.random.RandomState(1).randint(0, 1 << 62, 900).astype(np.uint64))
    made = D.sketch(values)
    assert set(made) <= set(values) and 24 <= len(made) <= 64
    assert D.sketch(values[:10]).tolist() == values[:10].tolist()


def test_size_classes_settle_sketch_and_bounds():
    assert [D.size_class(n) for n in (1, 2, 3, 4, 255, 256)] == [0, 1, 1, 2, 7, 8]
    assert [D.least_held(c, 0.8) for c in (0, 1, 2, 5)] == [1, 2, 4, 26]
    assert [D.needed(n, True, 0.8) for n in (1, 4, 5, 10, 16)] == [1, 4, 4, 8, 13]
    for n in (8, 16, 32, 64, 512):
        need = D.needed(n, False, 0.8)
        missed = sum(D.math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(need))
        assert need == 1 or missed <= D.MISS
    assert D.needed(16, False, 0.8) < D.needed(64, False, 0.8) < 0.8 * 64


def test_leaks_of_just_the_share(spark, docs):
    """Items of every size class in documents that hold exactly the share, or one shingle less."""
    rng = random.Random(3)
    rows, items = [], []
    for n in (5, 10, 15, 20, 40, 100, 300, 1000):
        for k in range(12):
            words = [f"x{rng.randint(0, 10**9)}" for _ in range(n + 4)]
            held, i = n * 4 // 5, len(items)
            items.append((i, " ".join(words)))
            rows.append((2 * i, "a b " + " ".join(words[: held + 4]) + " c d"))
            rows.append((2 * i + 1, "a b " + " ".join(words[-(held + 3) :]) + " c d"))
    frame = spark.createDataFrame(items, "item_id long, text string")
    for small in (D.SMALL, 0):
        got = sorted((r.doc_id, r.item_id) for r in D.leaks(docs(rows), frame, small=small).collect())
        assert got == [(2 * i, i) for i in range(len(items))]
