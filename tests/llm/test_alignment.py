import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mealmarts.llm import alignment as A
from mealmarts.llm.common import byte_alphabet
from tests.llm.conftest import sentence

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[2])


def spans(tokens):
    at, out = 0, []
    for t, size in tokens:
        out.append((t, at, at + size))
        at += size
    return out


def plain(text, libraries):
    """Groups and links of one text by all pairs of spans; None without tokens."""
    a, b = libraries
    letters = byte_alphabet()
    whole = (" " + text).encode()
    in_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    in_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        in_b.append((i, bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") else piece.replace("▁", " ").encode()))
    if not text or any(b"".join(t for _, t in x) != whole for x in (in_a, in_b)):
        return None
    sa, sb = (spans([(i, len(t)) for i, t in x]) for x in (in_a, in_b))
    cuts = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
    groups, low = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for i, s, e in x if low <= s and e <= cut) for x in (sa, sb)))
        low = cut
    links = [(x, y) for x, s, e in sa for y, t, f in sb if max(s, t) < min(e, f)]
    return len(sa), len(sb), groups, links


def brute(rows, libraries):
    found = [(doc, plain(text, libraries) if text else None) for doc, text in rows]
    count = Counter(p for _, f in found if f for p in set(f[3]))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for doc, f in found:
        if f is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        scores = [count[p] for p in links]
        out.append((doc, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(scores), digest))
    return sorted(out, key=repr)


def got(frame):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


ODD = [
    (50, "  two  spaces \n\n lines\t tab "), (51, "naïve café déjà vu 日本語 テスト 🙂 ​"), (52, "<|endoftext|> <s> </s> <0x0A> <unk>"),
    (53, "▁ is a space to one of them"), (54, "à ﬁ  x\x00y"), (55, "x" * 700), (56, " "), (57, "\n"), (58, "don't they'll I'VE 12345 3.14"),
    (59, " leading"), (59, " leading"), (None, " leading"),
]


def test_like_brute_force(spark, docs, libraries, odd_rows):
    rows = [r[:2] for r in odd_rows if len(r[1] or "") < 5000] + ODD
    frame = docs(rows).withColumnsRenamed({"lang": "pair", "source": "container"})
    found = A.align(frame, *FILES)
    assert got(A.score(found, A.pair_counts(found))) == brute(rows, libraries)


def test_many_containers(spark, docs, libraries):
    """Bitmaps and planes over full and split containers, with hot pairs and copies."""
    rng = random.Random(7)
    pool = [sentence(rng, 12) for _ in range(30)]
    rows = [(i, rng.choice(pool) + " the the the " * (i % 5) + sentence(rng, rng.randint(0, 6))) for i in range(300)]
    for container, limit in ((16, 1 << 22), (40, 1500)):
        found = A.align(docs(rows).repartition(3), *FILES, container, limit)
        assert found.filter("pair is not null").select("container").distinct().count() > 5
        assert got(A.score(found, A.pair_counts(found))) == brute(rows, libraries)
    links = Counter(p for _, t in rows for p in plain(t, libraries)[3])
    counted = {(r.pair >> 32, r.pair & 0xFFFFFFFF): r.n_links for r in A.pair_links(found).collect()}
    assert counted == links


def test_long_text_and_empty_table(spark, docs, libraries):
    text = sentence(random.Random(3), 60_000)
    found = A.align(docs([(1, text)]), *FILES)
    (row,) = got(A.score(found, A.pair_counts(found)))
    assert row[1] == len(libraries[0].encode(" " + text, add_special_tokens=False).ids) and row[2] == len(libraries[1].encode(text))
    assert row[4] == row[1] + row[2] - row[3]
    none = A.align(docs([]), *FILES)
    assert got(A.score(none, A.pair_counts(none))) == []


def test_ids_equal_the_library_for_every_character(libraries):
    """Ranks stand in for the library's merges: every assigned plane and class of character, in several surroundings."""
    pair = A.load(*FILES)
    points = [c for c in range(0x33480) if not 0xD800 <= c < 0xE000][::7] + list(range(0xE0000, 0xE0200))
    texts = [f" a{chr(c)}1 {chr(c)}{chr(c)} .{chr(c)}  {chr(c)}'s" for c in points]
    assert pair.a.encode_ordinary_batch(texts) == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.tuples(st.integers(0, 40), st.integers(0, 300)), st.integers(1, 70), min_size=1))
def test_pack_round_trip(entries):
    keys = np.array(sorted(p << 16 | d for p, d in entries))
    counts = np.array([entries[k >> 16, k & 0xFFFF] for k in keys.tolist()])
    width = 301 // 8 + 1
    pairs, n, docs, planes = A.pack(keys, counts, width)
    row, place, links = A.unpack(n, np.full(len(n), width), docs, planes)
    assert {(int(pairs[r]), int(p)): int(c) for r, p, c in zip(row, place, links)} == entries and len(row) == len(entries)
