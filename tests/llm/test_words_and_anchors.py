import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from mealmarts.llm import anchors as A
from mealmarts.llm import common, phrases
from mealmarts.llm.common import gram_hashes, leftmost_minima, merged, words


def test_words_split_on_ascii_white_space_only():
    assert words("a\x0bb\tc d e\x1cf") == ["a".encode(), b"b", "c d e\x1cf".encode()]
    assert words(None) == words("") == []


def test_leftmost_minima():
    rng = random.Random(1)
    for _ in range(50):
        keys = [rng.randint(0, 6) << 40 for _ in range(rng.randint(1, 60))]
        width = rng.randint(1, 12)
        want = {min(range(i, i + width), key=lambda j: (keys[j], j)) for i in range(len(keys) - width + 1)}
        assert leftmost_minima(np.array(keys, np.uint64), width).tolist() == sorted(want)
        end = rng.randint(0, len(keys))
        ends = np.where(np.arange(len(keys)) < end, end, len(keys))
        want = {min(range(i, i + width), key=lambda j: (keys[j], j)) for i in range(len(keys) - width + 1) if i + width <= ends[i]}
        assert leftmost_minima(np.array(keys, np.uint64), width, ends).tolist() == sorted(want)


def test_merged_spans_join_where_they_touch():
    starts, ends = merged(np.array([5, 0, 3, 9]), np.array([6, 3, 4, 12]))
    assert list(zip(starts.tolist(), ends.tolist())) == [(0, 4), (5, 6), (9, 12)]


def test_equal_windows_share_an_anchor_also_across_blocks(monkeypatch):
    rng = random.Random(2)
    shape = A.Shape("byte", 8, 40)
    shared = "".join(rng.choice("abc") for _ in range(150))
    one = "".join(rng.choice("abc") for _ in range(500)) + shared
    two = shared + "".join(rng.choice("abc") for _ in range(700))
    short = [None, "", "abc", one[:41]]

    def found(details):
        parts = list(A.anchors_by_block([one, *short, two], shape, details))
        return [np.concatenate(c) for c in zip(*parts)]

    whole = found(True)
    monkeypatch.setattr(A, "BLOCK", 64)
    assert all((a == b).all() for a, b in zip(whole, found(True)))
    places = {t: set(whole[1][whole[0] == i].tolist()) for i, t in ((0, one), (5, two))}
    for i in range(150 - 40 + 1):
        mine = {p - 500 - i for p in places[one] if 0 <= p - 500 - i <= shape.before}
        assert mine & {p - i for p in places[two] if 0 <= p - i <= shape.before}


def test_gram_hashes_of_short_input():
    assert len(gram_hashes(np.arange(3, dtype=np.uint64), 5)) == 0


def test_words_of_all_texts_are_hashed_together(monkeypatch):
    rng, called = random.Random(4), []
    hashed = xxhash.xxh3_64_intdigest
    monkeypatch.setattr(common.xxhash, "xxh3_64_intdigest", lambda word: called.append(word) or hashed(word))
    texts = [" ".join(rng.choice(["a", "bb", "é" * 9, "\x00", "\x00\x00"]) for _ in range(60)) for _ in range(20)]
    assert sum(len(found.anchor) for found in A.anchors_by_block([None, "", *texts], phrases.SHAPE, True)) and not called
    parts = [*" \t\n\x0b\x0c\r\x00\x1c\x85\u3000", "a", "b", "ab", *("x" * n for n in (7, 8, 9, 16, 64, 65, 300))]
    raws = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))).encode() for _ in range(500)]
    values, sizes = common.hashed_words(raws)
    split = [words(r.decode()) for r in raws]
    tokens = [w for row in split for w in row]
    assert sizes.tolist() == list(map(len, split)) and len(values) == len(tokens)
    assert len(set(zip(tokens, values.tolist()))) == len(set(tokens)) == len(set(values.tolist()))
    assert called and min(map(len, called)) > 64
    assert common.hashed_words([])[1].tolist() == [] and common.hashed_words([b"", b" ", b"a"])[1].tolist() == [0, 0, 1]


@pytest.mark.parametrize("shape", [A.Shape("word", 2, 6), A.Shape("byte", 3, 10), phrases.SHAPE])
def test_windows_of_all_contexts_are_hashed_together(monkeypatch, shape):
    rng, made, functions = random.Random(6), [], []
    text = [rng.choice([b"a", b"b", b"c"]) for _ in range(400)]
    joint = b" " if shape.unit == "word" else b""
    rows = []
    for _ in range(300):
        place = rng.choice([0, 1, 395, rng.randrange(396)])
        start = max(0, place - shape.before)
        body = text[start : place + shape.window]
        if len(body) - (place - start) >= shape.gram:
            rows.append((rng.randrange(9), 0, 1, rng.randrange(99), (place << A.MARK_BITS) | 5, place - start, joint.join(body)))
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=A.CONTEXT)
    keep = A._Hashes.__init__
    monkeypatch.setattr(A, "map_batches", lambda df, function, schema: functions.append(function))
    monkeypatch.setattr(A._Hashes, "__init__", lambda self, values: made.append(1) or keep(self, values))
    A.windows(None, shape)
    out = functions[0](batch)
    out = pa.Table.from_batches([out] if isinstance(out, pa.RecordBatch) else list(out)).to_pylist()
    assert len(made) == 1

    want, grams = [], A._Hashes(A.units(shape, [joint.join(text)])[0]).all(shape.gram).tolist()
    for anchor, _, _, doc, at, _, _ in rows:
        place = at >> A.MARK_BITS
        for start in range(max(0, place - shape.before), min(place, len(text) - shape.window) + 1):
            if min(range(start, start + shape.before + 1), key=lambda i: (grams[i], i)) == place:
                want.append((anchor, doc, start, 5, at, tuple(text[start : start + shape.window])))
    got = [(doc, start, mark, at) for _, doc, start, mark, at in (r.values() for r in out)]
    assert Counter(got) == Counter(w[1:5] for w in want)
    # Of a row the output keeps the order, so phrases and strings agree one by one.
    strings = [(w[0], w[5]) for w in want]
    numbers = [r["phrase"] for r in out]
    assert len(set(zip(strings, numbers))) == len(set(strings)) == len(set(numbers))


def test_automaton_has_no_node_with_a_letter_for_every_word():
    rng = random.Random(7)
    names = [f"w{i}".encode() for i in range(3000)]
    told = {tuple(rng.choice(names) for _ in range(4)): i for i in range(3000)}
    automaton, written = phrases._automaton(list(told.items()))
    assert max(Counter(edge[0] for edge in automaton.dump()[1]).values()) < 600
    line = [w for row in rng.sample(list(told), 50) for w in (*row, b"other", rng.choice(names))]
    want = [(i + 3, told[tuple(line[i : i + 4])]) for i in range(len(line) - 3) if tuple(line[i : i + 4]) in told]
    assert [(end // 2, first) for end, first in automaton.iter(written(line))] == want and len(want) >= 50
