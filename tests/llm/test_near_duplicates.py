import random

import pytest

from mealmarts.llm import near_duplicates as N


def brute(rows, percent=85):
    sets = []
    for _, text in rows:
        w = [x.encode().lower() for x in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sets, find


def expected(rows):
    sets, find = brute(rows)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and sets[i] and rows[j][0] is not None]
        component = min(ids, default=doc) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_odd_documents(docs, odd_rows):
    assert got(N.near_duplicates(docs(odd_rows))) == expected(odd_rows)


@pytest.fixture(scope="module")
def family():
    """Many near copies of one text and a chain of copies of copies, among strangers with one common line."""
    rng = random.Random(8)
    line = "all of us share this very common line here"
    fresh = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    base, rows = fresh(200), []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(200)] = f"e{rng.randint(0, 9999)}"
        rows.append((i, " ".join(copy)))
    chain = fresh(300)
    for i in range(60, 90):
        chain = list(chain)
        for _ in range(4):
            chain[rng.randrange(300)] = f"c{rng.randint(0, 9999)}"
        rows.append((i, " ".join(chain)))
    return rows + [(i, f"{line} " + " ".join(fresh(60))) for i in range(90, 140)]


def test_family(docs, family):
    assert got(N.near_duplicates(docs(family))) == expected(family)


def test_large_nodes_branch_and_meet_in_blocks(docs, family):
    assert got(N.near_duplicates(docs(family), limit=8)) == expected(family)


def test_alike_but_not_similar_documents_meet_all_blocks(docs):
    """A template of which every document has two thirds, some pairs more: few link, none may be lost."""
    rng = random.Random(12)
    fresh = lambda n: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    template, rows = fresh(200), []
    for i in range(60):
        rows.append((i, f"{template} {fresh(60)}"))
        if i % 6 == 0:
            rows.append((1000 + i, f"{rows[-1][1]} {fresh(5)}"))
    made = N.near_duplicates(docs(rows), limit=8)
    assert got(made) == expected(rows)
    assert sum(not r.kept for r in made.collect()) == 10


def test_alike_classes_cost_rows_in_proportion(spark):
    """Members of a node in which all share all tokens: n and a tenth of pivots, and no more if they are one component."""
    sizes = []
    for n in (1000, 2000, 4000):
        sets = spark.range(1, n + 1).selectExpr("id as rep", "array_repeat(cast(7 as int), 32) as tokens")
        small, large = N.nodes(sets, trees=2, limit=100)
        labels = sets.selectExpr("rep", "cast(1 as long) as label")
        assert small.count() == 0 and N.remaining(large, labels, 100).count() == 0
        one_out = labels.selectExpr("rep", "if(rep = 17, 17, 1) as label")
        assert N.remaining(large, one_out, 100).count() == 2 * (n + n // 100 - 1)
        sizes.append(N.pivoted(large, 100).count())
    assert all(2 * n <= size <= 2.5 * n for n, size in zip((1000, 2000, 4000), sizes))


@pytest.mark.parametrize("labelled", [0, 30])
def test_every_pair_of_a_large_node_is_linked_or_meets(spark, labelled):
    sets = spark.range(1, 61).selectExpr("id as rep", "array_repeat(cast(7 as int), 32) as tokens")
    label = {i: 1 if i <= labelled else i for i in range(1, 61)}
    labels = spark.createDataFrame(list(label.items()), "rep long, label long")
    large = N.nodes(sets, trees=1, limit=8)[1]
    members = {}
    for r in N.remaining(large, labels, 8).collect():
        members.setdefault(r.node, set()).add(r.rep)
    met = {(a, b) for m in members.values() for a in m for b in m}
    assert all((a, b) in met or label[a] == label[b] for a in label for b in label)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {(x, find(x)) for a, b in edges if a != b for x in (a, b)}
    assert {tuple(r) for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


def test_empty_table_and_clashing_columns(docs):
    assert N.near_duplicates(docs([(1, "x")]).limit(0)).count() == 0
    more = docs([(1, "a b"), (2, "A b")]).selectExpr("*", "1 as rep", "2 as key", "3 as node", "4 as component_id")
    assert got(N.near_duplicates(more)) == [(1, 1, 1, True), (2, 1, 1, False)]
