import random

from mealmarts.llm import sharding as S


def plain_best_fit(sizes, capacity):
    rooms, out = [], []
    for size in sizes:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= size]
        if fits and size:
            i = min(fits)[1]
        elif fits:
            i = min(fits)[1]
        else:
            rooms.append(max(capacity, size))
            i = len(rooms) - 1
        rooms[i] -= size
        out.append(i)
    return out


def test_tree_chooses_the_tightest_bin():
    rng = random.Random(4)
    for _ in range(40):
        sizes = sorted((rng.randint(1, 60) for _ in range(rng.randint(0, 400))), reverse=True)
        got, want = S.best_fit(sizes, 100), plain_best_fit(sizes, 100)
        assert max(got, default=0) == max(want, default=0)
        load = {}
        for size, b in zip(sizes, got):
            load[b] = load.get(b, 0) + size
        assert all(v <= 100 for v in load.values())


def test_open_bins_split_their_leaves():
    bins, rng = S.OpenBins(leaf=4), random.Random(1)
    held = []
    for i in range(300):
        room = rng.randint(1, 50)
        bins.add(room, i)
        held.append((room, i))
        if i % 3 == 0:
            size = rng.randint(1, 55)
            want = min([h for h in held if h[0] >= size], default=None)
            assert bins.take_tightest(size) == want
            if want:
                held.remove(want)


def test_shards(docs, odd_rows):
    rows = [*odd_rows, *[(100 + i, "hot copy " * 20) for i in range(60)], *[(200 + i, f"text {i} " * (1 + i % 9)) for i in range(80)]]
    placed = S.place(docs(rows).selectExpr("*", "1 as key", "2 as shard", "3 as pack"), 8).collect()
    assert len(placed) == len(rows)
    by_shard, by_text = {}, {}
    for r in placed:
        by_shard.setdefault(r.shard, []).append(r)
        by_text.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert set(by_shard) <= set(range(8)) and all(len(s) == 1 for s in by_text.values())
    for rs in by_shard.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        ordered = sorted(rs, key=lambda r: r.slot)
        assert [r.doc_id for r in ordered] == sorted([r.doc_id for r in ordered], key=lambda d: (d is not None, d or 0))
    group = {}
    for r in placed:
        group[r.text_crc32, r.size] = group.get((r.text_crc32, r.size), 0) + r.size
    least = max(*group.values(), sum(r.size for r in placed) / 8)  # no capacity below this will do
    assert max(sum(r.size for r in rs) for rs in by_shard.values()) <= 1.25 * least


def test_fixed_capacity_uses_few_shards(docs):
    rows = [(i, "x" * (9 + 10 * (i % 6))) for i in range(120)]
    of = S.assign(docs(rows), capacity=200).join(S.groups(docs(rows)), "key").groupBy("shard").sum("size").collect()
    total = sum(len(t) + 1 for _, t in rows)
    assert len(of) <= -(-total // 200) + 8


def test_empty_table(docs):
    assert S.place(docs([(1, "a")]).limit(0), 8).count() == 0
