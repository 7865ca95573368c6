"""Both substring operators against brute force."""

import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from mealmarts.llm import anchors as A
from mealmarts.llm import phrases, suffixes
from mealmarts.llm.common import words
from mealmarts.llm.suffixes import common_prefix, deep_shallow, shared_extents
from tests.llm.conftest import sentence


def brute_bytes(rows, window):
    """Every row is a document."""
    texts = [(r[1] or "").encode() for r in rows]
    counts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = set()
        for i in range(len(t) - window + 1):
            if counts[t[i : i + window]] > 1:
                gone.update(range(i, i + window))
        spans = sum(1 for g in gone if g - 1 not in gone)
        out.append((r[0], len(t), len(gone), spans, bytes(b for i, b in enumerate(t) if i not in gone)))
    return sorted(out, key=repr)


def order(row):
    """Null ids first, by a hash of the text; then ids, and texts of one id by a hash."""
    text = (row[1] or "").encode()
    first = xxhash.xxh64_intdigest(text, 42)
    unnamed = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), first) >> 3
    return row[0] is not None, unnamed if row[0] is None else row[0], first & A.MARK


def brute_words(rows, window):
    """Rows of one id and one text are the same document."""
    first, out = {}, defaultdict(set)
    for r in sorted(dict.fromkeys(rows), key=order):
        w = words(r[1])
        for i in range(len(w) - window + 1):
            if first.setdefault(tuple(w[i : i + window]), (r, i)) != (r, i):
                out[r].update(range(i, i + window))
    return sorted(
        [(r[0], len(words(r[1])), len(out[r]), b" ".join(x for i, x in enumerate(words(r[1])) if i not in out[r]).decode()) for r in rows],
        key=repr,
    )


def collected(df):
    return sorted([tuple(bytes(c) if isinstance(c, bytearray) else c for c in r) for r in df.collect()], key=repr)


def test_bytes(docs, odd_rows):
    assert collected(suffixes.remove_repeats(docs(odd_rows))) == brute_bytes(odd_rows, 200)


def test_bytes_of_an_anchor_with_many_contexts(docs, odd_rows):
    assert collected(suffixes.remove_repeats(docs(odd_rows), split=1)) == brute_bytes(odd_rows, 200)


def test_small_windows(docs, odd_rows):
    rows = [r for r in odd_rows if r[0] not in (15,)]
    shape = A.Shape("byte", 8, 30)
    assert collected(suffixes.remove_repeats(docs(rows), shape)) == brute_bytes(rows, 30)


def test_words(docs, odd_rows):
    assert collected(phrases.remove_repeats(docs(odd_rows))) == brute_words(odd_rows, 20)


def test_words_dealt_to_many_shards(docs, odd_rows, monkeypatch):
    monkeypatch.setattr(phrases, "SPLIT", 1)
    monkeypatch.setattr(phrases, "SHARD", 2)
    assert collected(phrases.remove_repeats(docs(odd_rows))) == brute_words(odd_rows, 20)


@pytest.mark.parametrize("module", [phrases, suffixes])
def test_empty_table_and_clashing_columns(spark, docs, module):
    frame = docs([(1, "a b c")]).limit(0)
    assert module.remove_repeats(frame).count() == 0
    more = docs([(1, "a b c"), (2, None)]).selectExpr("*", "1 as doc", "2 as anchor", "3 as kept", "4 as n_removed", "5 as mark")
    assert [r.n_removed for r in module.remove_repeats(more).collect()] == [0, 0]


def test_deep_shallow_orders_and_extents():
    strings = [b"abc" * 40 + bytes([i % 5]) + b"z" * (i % 7) for i in range(40)] + [b"", b"abc" * 40, b"abc" * 40]
    order = deep_shallow(strings, 16)
    assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
    befores = [bytes([97 + i % 3]) * 30 for i in range(len(strings))]
    for i, found in enumerate(shared_extents(befores, strings, 60)):
        pairs = [(common_prefix(befores[i], befores[j]), common_prefix(strings[i], strings[j])) for j in range(len(strings)) if j != i]
        want = {p for l, d in pairs if l + d >= 60 for p in range(-l, d)}
        assert {p for l, d in found for p in range(-l, d)} == want


@pytest.fixture(scope="module")
def crowd():
    """Thousands of texts without an id and of one id, some sharing a passage; among them texts whose hashes agree in 16 bits."""
    rng = random.Random(14)
    passages = [sentence(rng, 50) for _ in range(40)]
    rows = []
    for i in range(3000):
        text = sentence(rng, 45, "abcdefghijklmnop")
        if i % 30 == 0:
            text = f"{text} {rng.choice(passages)} {sentence(rng, 5)}"
        rows.append((None if i % 2 else 77, text))
    marks = Counter((r[0], xxhash.xxh64_intdigest(r[1].encode(), 42) & 0xFFFF) for r in rows)
    assert max(marks.values()) > 1
    return rows + rows[:40] + [(3, passages[0]), (1 << 62, passages[1]), (-5, passages[2])]


def test_texts_without_an_id_or_of_one_id_are_told_apart(docs, crowd):
    assert collected(suffixes.remove_repeats(docs(crowd))) == brute_bytes(crowd, 200)
    assert collected(phrases.remove_repeats(docs(crowd))) == brute_words(crowd, 20)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_copies_of_a_row_cost_in_proportion(docs, doc_id):
    """Places gathered for a document do not grow with its copies."""
    text, sizes = sentence(random.Random(3), 300), []
    for copies in (50, 200):
        rows = [(doc_id, text)] * copies
        found = A.occurrences(docs(rows), phrases.SHAPE)
        none = found.limit(0).select("doc", F.lit(0).cast("long").alias("mark"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("stop"))
        spans = A.spans_of(found, none)
        sizes.append([r[0] for r in spans.select(F.size("places")).collect()])
        assert collected(phrases.remove_repeats(docs(rows))) == brute_words(rows, 20)
        assert collected(suffixes.remove_repeats(docs(rows))) == brute_bytes(rows, 200)
    assert sizes[0] == sizes[1] and len(sizes[0]) == 1
