import base64
import random

import public_tokenizers
import pytest
import tiktoken

from mealmarts.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    pieces = ["it's ", "don't", "'re", " \n\n ", "\t", "  x", "123", "é", "日本", "!?", "　", " ", "'", "s", "<|endoftext|>", "🙂"]
    mixed = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    return [*mixed, None, "", " " * 500, "a" * 500, "a" * 3000 + " b", "\n" * 700 + "x", "x " * 900, "'r" * 200]


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 512), (64, 24), (40, 40), (100, 8)])
def test_same_ids_as_the_library(docs, reference, chunk, overlap):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "again"), (None, "x" * 90), (None, "x" * 90)]
    got = sorted(((r.doc_id, tuple(r.ids)) for r in bpe.encode(docs(rows), RANKS, PATTERN, chunk, overlap).collect()), key=repr)
    assert got == sorted(((i, tuple(reference.encode_ordinary(t or ""))) for i, t in rows), key=repr)


def test_decoding_gives_the_bytes_back(docs):
    rows = [(i, t) for i, t in enumerate(texts())]
    back = bpe.decode(bpe.encode(docs(rows), RANKS, PATTERN, 64, 24), RANKS, PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded) for r in back} == {i: (t or "").encode() for i, t in rows}


def test_empty_table_and_clashing_columns(docs):
    frame = docs([(1, "a")])
    assert bpe.encode(frame.limit(0), RANKS, PATTERN).count() == 0
    more = frame.selectExpr("*", "1 as ids", "2 as key", "3 as k", "4 as n", "5 as decoded")
    assert bpe.digests(bpe.decode(bpe.encode(more, RANKS, PATTERN), RANKS, PATTERN)).count() == 1
