import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mealmarts.llm import token_files as K
from mealmarts.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_levels_give_every_run_back():
    rng = np.random.RandomState(1)
    for ids in (rng.randint(0, 1 << 20, 3000), rng.randint(0, 200, 1500), np.array([], int), np.array([0, 255, 256, 65535, 65536, (1 << 32) - 1])):
        levels = K.encode_levels(ids)
        again = [K.Level(**x.parts()) for x in levels]
        for _ in range(50):
            a = rng.randint(0, len(ids) + 1)
            n = rng.randint(0, len(ids) - a + 1)
            assert K.read_ids(again, a, n).tolist() == ids[a : a + n].tolist()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    words = ["It's", "a", "Word,", "x)).", "É.", "12.3", "日本語", "don't!!", "İ.", "…", "<|endoftext|>", "a　b", "\x1c", "Σας."]
    made = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(40)]
    return made + [(41, None), (42, ""), (42, ""), (None, "null id"), (43, "word " * 4000)]


def test_files_round_trip(spark, docs, rows):
    path = scratch_path(spark, "test-tokens")
    K.write(docs(rows), path, PATH, 2, segment_ids=300)
    tokenizer = Tokenizer.from_file(PATH)
    want, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = sorted(((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in K.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    flat = np.concatenate([np.frombuffer(w[3], "<u4") for w in want])
    for a, n in ((0, 5), (290, 20), (start - 4, 4), (1000, 700)):
        piece = [r.id for r in K.read_slice(spark, path, a, n).orderBy("place").collect()]
        assert piece == flat[a : a + n].tolist()
    assert K.read_slice(spark, path, start + 5, 9).collect() == []


def test_a_slice_opens_only_its_segments(spark, docs):
    path = scratch_path(spark, "test-tokens")
    K.write(docs([(i, "some words here " * 30) for i in range(400)]), path, PATH, 2, segment_ids=500)
    segments = K.read(spark, path)
    total = segments.agg({"n_ids": "sum"}).first()[0]
    hit = K.slice_segments(spark, path, total // 2, 10)
    assert hit.count() in (1, 2) and segments.count() > 50
    plan = K.slice_segments(spark, path, total // 2, 10)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(range," in plan and "LessThan(range_of" in plan and "Join" not in plan


def test_empty_table_and_clashing_columns(spark, docs):
    for frame in (docs([(1, "a")]).limit(0), docs([(1, "a")]).selectExpr("*", "1 as range", "2 as start", "3 as ids")):
        path = scratch_path(spark, "test-tokens")
        K.write(frame, path, PATH, 2)
        assert K.digests(K.read_documents(spark, path)).count() == frame.count()


def test_dropping_words_keeps_the_ids(monkeypatch):
    monkeypatch.setattr(K, "CACHE", 20)
    encoder, rng = K.WordEncoder(PATH), random.Random(2)
    for _ in range(30):
        texts = [" ".join(rng.choice("abcdé,.!'") * rng.randint(1, 5) for _ in range(20)) for _ in range(3)]
        want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in encoder.encode(texts)] == want


def test_ids_are_those_of_the_library(spark, docs):
    """As the library gives them without any setting: the string of an added token is its one id."""
    tokenizer = Tokenizer.from_file(PATH)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in added and "<|startoftext|>" in added
    forms = ["{}", "x{}", "{}y", "x){}.", "({}!)", "{}{}", "é{}́.", "{}'s", "<{}>"]
    pieces = [f.format(*[a] * f.count("{}")) for a in added for f in forms]
    pieces += ["<|endoftext|", "|endoftext|>", "<|EndOfText|>", "<|ENDOFTEXT|>)", "<|endoftext |>", "plain", "Word).", "<|", "|>"]
    rng = random.Random(12)
    texts = [*pieces, "x <|endoftext|> y"] + [" ".join(rng.choice(pieces) for _ in range(30)) for _ in range(200)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[len(pieces)] == [343, 49407, 344]
    assert [x.tolist() for x in K.WordEncoder(PATH).encode(texts)] == want
    path = scratch_path(spark, "test-tokens")
    K.write(docs(list(enumerate(texts))), path, PATH, 2)
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in K.read_documents(spark, path).collect()}
    assert got == {i: [*ids, 2] for i, ids in enumerate(want)}


def test_words_of_all_kinds_equal_the_library():
    """Letters with every sign, accents composed and not, digits, apostrophes, white space beyond ASCII, other scripts."""
    encoder, rng = K.WordEncoder(PATH), random.Random(4)
    signs = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    points = [chr(c) for c in range(0x21, 0x3000) if chr(c).isprintable()]
    texts = [f"Ab{s}cD {s}{s}x {s} x{s} 12{s}3 É{s}é e\u0301{s} it's{s}" for s in signs]
    texts += [f"x{p} {p}y {p}{p} a{p}b 1{p}" for p in points]
    letters = "abcXYZéÈüßÿ×÷ªºÆœŒİıſΣς'’!?.,-_<|>0123\u00a0\u0085\x1c\x7f"
    texts += [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(8)) for _ in range(3000)]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [x.tolist() for x in encoder.encode(texts)]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []
