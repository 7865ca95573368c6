import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from mealmarts.llm import conversation_trie as K

SCHEMA = "conv_id long, turn long, role string, text string, digest int, depth string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), digest(role, text), role, text))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h]) + tuple(mine[h:])
    return tree(whole)


def tree(whole):
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(n)))).encode()).hexdigest(),
        )
        for n, m in members.items()
    )


def got(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=lambda r: (r[0], r[1], r))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def trie(spark, rows, band=K.BAND):
    return got(K.trie(*K.rebuild(K.numbered(frame(spark, rows))), band))


def made(seed, convs=260, alphabet=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(700), convs):
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), "é" * rng.randint(0, alphabet)))
    return rows


@pytest.mark.parametrize("band", [2, 3, 16])
def test_like_brute_force(spark, band):
    rows = made(band)
    assert trie(spark, rows, band) == brute(rows)


def test_nulls_ties_repeats_and_absent_bases(spark):
    rows = made(5, 40, 1)
    rows += [(None, 1, "user", "lost"), (None, None, None, None), (705, None, None, None), (705, 0, "user", None), (705, 0, "user", None)]
    rows += [(802, 3, "user", "b"), (802, 3, "user", "a"), (802, 3, "assistant", "a"), (-105, 1, "user", "x"), (-105, 2, "user", "y")]
    rows += [(-100, 1, "user", "base"), (1 << 60, 1, "user", ""), (900, None, "user", "first"), (900, -4, "user", "second"), (901, 1, "u", "z")]
    assert trie(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert trie(spark, []) == []


def test_long_conversations_and_a_hot_one(spark, monkeypatch):
    """Scans over several blocks, rounds over several bands, many equal conversations."""
    monkeypatch.setattr(K, "BLOCK", 7)
    rng = random.Random(1)
    long = [("user", rng.choice("ab")) for _ in range(150)]
    rows = [(c, i, *t) for c in (100, 101, 102, 103) for i, t in enumerate(long[: 40 + c % 4 * 35])]
    rows += [(c, i, "user", "same") for c in range(200, 420) for i in range(4)]
    assert trie(spark, rows, 3) == brute(rows)


def test_own_sequences(spark):
    """The trie takes any sequences, also members without a turn."""
    whole = {1: (("", "a"), ("", "b")), 2: (("", "a"),), 3: ()}
    turns = spark.createDataFrame(
        [(c, d + 1, bytearray(digest(*t)), len(t[1])) for c, p in whole.items() for d, t in enumerate(p)],
        "conv_id long, depth long, digest binary, length long",
    )
    members = spark.createDataFrame([(c, len(p)) for c, p in whole.items()], "conv_id long, n_turns long")
    assert got(K.trie(turns, members)) == tree(whole)


def test_ids_of_one_node_in_pieces(spark):
    ends = spark.createDataFrame([(1, 2, 3, c) for c in range(1000)] + [(1, 2, 4, -5)], "depth long, k1 long, k2 long, conv_id long")
    rows = {r.k2: r.ends_sha256 for r in K.end_digests(ends.repartition(5), 200).collect()}
    assert rows == {k: hashlib.sha256(s.encode()).hexdigest() for k, s in ((3, ",".join(map(str, range(1000)))), (4, "-5"))}
