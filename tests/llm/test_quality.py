import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mealmarts.llm import quality as Q


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_counts(docs, odd_rows):
    rows = [*odd_rows, (30, "a\n\na\r\na\r\n \n \nb#<é>"), (31, "x y z x y z x y"), (32, "a b a b a b")]
    got = Q.statistics(docs(rows)).select("doc_id", *Q.COLUMNS[1:6]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *brute_counts(t)) for i, t in rows], key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(700):
        w = [word() for _ in range(rng.randint(60, 300))]
        bad = i % 7 == 0
        if bad:
            w = [x + "***" for x in w] if i % 2 else [x.upper() for x in w]
        rows.append((i, " ".join(w), "en" if i % 3 else None, "big" if i % 5 else f"tiny{i}"))
    return rows


def test_outliers_go_and_clean_documents_stay(docs, corpus):
    judged = Q.judge(Q.statistics(docs(corpus))).collect()
    assert {r.doc_id for r in judged if not r.kept} == {i for i, *_ in corpus if i % 7 == 0}


def test_estimate_is_the_core_of_least_determinant(spark):
    """Against plain concentration steps in numpy from many random subsets."""
    rng = np.random.RandomState(5)
    data = rng.normal(size=(400, 6)) * [0.5, 0.4, 0.6, 0.5, 0.7, 0.9]
    data[:80] += 6
    frame = spark.createDataFrame([("g", *map(float, r)) for r in data], ["g", *[f"v{i}" for i in range(6)]])
    found = Q.estimates(frame).first()
    h, best = 300, None
    for _ in range(60):
        chosen = rng.choice(400, 8, False)
        for _ in range(30):
            centre, scatter = data[chosen].mean(0), np.cov(data[chosen].T, bias=True) + np.diag(np.square(Q.FLOOR))
            d = np.einsum("ij,jk,ik->i", data - centre, np.linalg.inv(scatter), data - centre)
            chosen = np.argsort(d)[:h]
        det = np.linalg.det(np.cov(data[chosen].T, bias=True))
        if best is None or det < best[0]:
            best = det, data[chosen].mean(0)
    assert np.allclose(found.centre, best[1], atol=0.05) and found.n == 400


@pytest.mark.parametrize(
    ("feature", "share"), [("symbols", 0.17), ("bare_words", 0.28), ("upper", 0.28), ("dup_lines", 0.75), ("repeats", 0.48)]
)
def test_each_feature_can_reject_by_itself(feature, share):
    """What the module says a share has to reach over texts that have none and do not scatter."""
    floor = Q.FLOOR[Q.FEATURES.index(feature)]
    distance = lambda x: (np.arcsin(np.sqrt(x)) / floor) ** 2
    assert distance(share - 0.01) <= Q.CUTOFF < distance(share)


def test_verdicts_equal_plain_distances(docs, corpus):
    """Every verdict and distance again in numpy, from the estimates of the groups."""
    stats = Q.statistics(docs(corpus))
    judged = {r.doc_id: r for r in Q.judge(stats).collect()}
    rows = stats.filter(~Q.base_failed()).select("doc_id", "lang", "source", *[v.alias(f"v{i}") for i, v in enumerate(Q.vector())])
    groups = F.explode(F.array(F.concat_ws("/", F.coalesce("lang", F.lit("-")), "source"), F.coalesce("lang", F.lit("-")), F.lit("all"))).alias("g")
    found = {r.g: r for r in Q.estimates(rows.select(groups, *[f"v{i}" for i in range(6)])).collect()}
    for r in rows.collect():
        names = (f"{r.lang or '-'}/{r.source}", r.lang or "-", "all")
        e = next(found[g] for g in names if g in found)
        d = np.array(r[3:]) - e.centre
        squared = d @ np.array(e.inverse).reshape(6, 6) @ d
        assert judged[r.doc_id].distance == pytest.approx(squared, rel=1e-6, abs=1e-9)
        assert judged[r.doc_id].kept == (squared <= Q.CUTOFF)


def test_consistency_factor():
    rng = np.random.RandomState(1)
    d = np.sum(rng.normal(size=(200_000, 6)) ** 2, axis=1)
    core = d[d <= np.quantile(d, 0.75)]
    assert Q.consistency() == pytest.approx(1 / (core.mean() / 6), rel=0.01)


def test_small_groups_empty_table_and_clashing_columns(docs, corpus):
    few = Q.judge(Q.statistics(docs(corpus[:30]))).collect()
    assert all(r.distance is None and r.kept == (not r.base_failed) for r in few)
    assert Q.judge(Q.statistics(docs(corpus[:1]).limit(0))).count() == 0
    more = docs(corpus[:20]).withColumns({c: F.lit(1) for c in ("g", "v0", "kept", "distance", "n_words", "centre")})
    assert Q.judge(Q.statistics(more)).count() == 20
