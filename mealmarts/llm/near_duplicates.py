"""MinHash near-duplicates by a chosen-path similarity join.

A document's set holds its distinct five-word shingles (A-Z lower-cased). Equal sets are one class
and are handled as one. Every class has ``TOKENS`` minwise tokens and a ``SKETCH``-byte sketch.

Each of ``TREES`` independent trees branches the classes by a minwise token; a node of more than
``NODE`` classes branches again by ``BRANCHES`` further tokens chosen by its path, up to ``DEPTH``
levels, unless a branch keeps over half of it: its members are alike then. A pair of similarity s parts from a branch with probability 1 - s, so it meets in a small
node of some tree with probability 1 - (1 - s)^TREES or more where one level is enough: 0.99999 at
0.85, 0.9999 at 0.8; two branches a level keep it so below. Small nodes are compared exhaustively on
sketches. Pairs whose sketches agree within five standard errors are confirmed on their full
sets, from the texts, unless they are linked already: inside a node linked classes form trees, and
later trees start from the links of the first. So a node of n classes costs n - 1 links, not n^2.

A node still too large is cut into blocks of ``NODE``, and one in ``PIVOT`` as many members, its pivots,
joins every block, so that near copies of one text become one component in rows that grow with n. In
the end the members outside the node's largest component, and they alone, meet all blocks. So each pair
of a node is compared or linked already, and r such members cost n * (1 + r / NODE) rows in place of
n * n / NODE. Members that are alike but not similar enough to link are all outside: there r is near n.

Components follow from the links by large-star and small-star rounds until nothing changes.

Null or empty texts have no set, are linked with nothing and are their own component. With fewer
than five words the whole sequence is one shingle. Rows with one id are one document, decided alike;
a null id counts as no id: its row takes its class's component. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mealmarts.llm.common import gram_hashes, map_batches, runs, word_hashes
from mealmarts.session import stage

SHINGLE, TREES, TOKENS, SKETCH = 5, 6, 32, 128
NODE, BRANCHES, DEPTH, PIVOT = 1000, 2, 4, 10
_RANDOM = np.random.RandomState(7)
_FACTORS = (_RANDOM.randint(0, 2**31, TOKENS + SKETCH).astype(np.uint32) * np.uint32(2)) | np.uint32(1)
_TERMS = _RANDOM.randint(0, 2**31, TOKENS + SKETCH).astype(np.uint32)
_AT_ONCE = 4096  # shingles hashed at once


def shingle_set(text: str | None) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct shingles."""
    tokens = text.encode().lower().split() if text else []
    return np.unique(gram_hashes(word_hashes(tokens), min(SHINGLE, len(tokens)) or 1) + np.uint64(len(tokens) < SHINGLE))


def minwise(values: np.ndarray) -> np.ndarray:
    """Least value of every hash function over the set."""
    low = (values >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(TOKENS + SKETCH, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(low), _AT_ONCE):
        hashed = low[i : i + _AT_ONCE] * _FACTORS + _TERMS
        np.minimum(least, hashed.min(axis=0), out=least)
    return least


def _key(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, tokens, sketch) per row; the last three null for an empty set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, tokens, sketches = [], [], [], []
        for text in batch.column(1).to_pylist():
            values = shingle_set(text)
            sizes.append(len(values))
            least = minwise(values) if len(values) else None
            keys.append(_key(values) if len(values) else None)
            tokens.append(least[:TOKENS].view(np.int32).tolist() if len(values) else None)
            sketches.append(((least[TOKENS:] * np.uint32(0x9E3779B1)) >> 24).astype(np.uint8).tobytes() if len(values) else None)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(tokens, pa.list_(pa.int32())), pa.array(sketches, pa.binary())],
            names=["doc_id", "n_shingles", "key", "tokens", "sketch"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, run, "doc_id long, n_shingles long, key binary, tokens array<int>, sketch binary")


def nodes(sets: DataFrame, trees: int = TREES, limit: int = NODE, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(tree, node, rep) of every node of two to ``limit`` members, and (tree, node, rep, n) of those that stay larger."""
    token = F.col("tokens")[F.pmod("pick", F.lit(TOKENS))]
    current = (
        sets.select("tokens", "rep", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        .withColumn("pick", F.col("tree"))
        .select("tree", F.xxhash64("tree", token).alias("node"), "rep")
    )
    members = _sized(stage(current, "nodes"))
    out, blocks, large = members.filter(F.col("n") <= limit), [], members.filter(F.col("n") > limit)
    for _ in range(depth - 1):
        if large.isEmpty():
            break
        branched = (
            large.select("tree", F.col("node").alias("parent"), F.col("n").alias("above"), "rep", F.explode(F.sequence(F.lit(1), F.lit(BRANCHES))).alias("branch"))
            .withColumn("pick", F.xxhash64("parent", "branch"))
            .join(sets.select("rep", "tokens"), "rep")
            .select("tree", F.xxhash64("parent", "branch", token).alias("node"), "rep", "parent", "above")
        )
        children = _sized(stage(branched, "branches"))
        # Where a branch keeps over half of its node, the members are alike and further branches would only repeat them.
        alike = stage(children.filter("2 * n > above").select("parent").distinct(), "alike")
        blocks.append(large.join(alike.withColumnRenamed("parent", "node"), "node", "left_semi"))
        children = children.join(alike, "parent", "left_anti").select("tree", "node", "rep", "n")
        out = out.unionByName(children.filter(F.col("n") <= limit))
        large = children.filter(F.col("n") > limit)
    return out.select("tree", "node", "rep"), functools.reduce(DataFrame.unionByName, [
        rows.select("tree", "node", "rep", "n") for rows in (*blocks, large)
    ])


def _block(size: str, limit: int) -> tuple[Column, Column]:
    """The number of blocks of a node of ``size`` members, and a member's own."""
    count = F.ceil(F.col(size) / limit).cast("int")
    return count, F.pmod(F.xxhash64("rep"), count).cast("int")


def pivoted(large: DataFrame, limit: int = NODE) -> DataFrame:
    """(tree, node, rep): a node for each block of a large node, the large node's pivots in every one."""
    count, own = _block("n", limit)
    pivot = F.pmod(F.xxhash64("node", "rep"), F.col("n")) < max(1, limit // PIVOT)  # this many of n, by a hash
    places = F.when(pivot, F.sequence(F.lit(0), count - 1)).otherwise(F.array(own))
    return large.select("tree", "node", "rep", F.explode(places).alias("block")).select(
        "tree", F.xxhash64("node", "block").alias("node"), "rep"
    )


def remaining(large: DataFrame, labels: DataFrame, limit: int = NODE) -> DataFrame:
    """(tree, node, rep): members of large nodes outside their node's largest component, with each of its blocks.

    ``labels`` (rep, label) has the components found so far; a class that is not in it is alone.
    """
    labelled = stage(_labelled(large, labels), "large_labelled")
    most = F.max_by("label", F.struct("count", "label")).alias("most")
    largest = stage(labelled.groupBy("node", "label").count().groupBy("node").agg(most), "largest")
    others = stage(labelled.join(largest, "node").filter("label != most").select("tree", "node", "rep", "n"), "others")
    sizes = stage(others.groupBy("node").agg(F.count("*").alias("m")), "others_sizes")
    count, own = _block("n", limit)
    groups, group = _block("m", limit)
    everyone = large.join(sizes, "node").select(
        "tree", "node", "rep", own.alias("block"), F.explode(F.sequence(F.lit(0), groups - 1)).alias("group")
    )
    outside = others.join(sizes, "node").select(
        "tree", "node", "rep", F.explode(F.sequence(F.lit(0), count - 1)).alias("block"), group.alias("group")
    )
    met = everyone.unionByName(outside)
    return met.select("tree", F.xxhash64("node", "block", "group").alias("node"), "rep").distinct()


def _sized(rows: DataFrame) -> DataFrame:
    """``rows`` of nodes of two or more, with the node's size ``n``."""
    sizes = rows.groupBy("node").count().filter("count > 1").withColumnRenamed("count", "n")
    return stage(rows.join(stage(sizes, "node_sizes"), "node"), "members")


def _agreement(similarity: float) -> int:
    """Sketch bytes that must agree: five standard errors below the expected number."""
    return math.floor(SKETCH * similarity - 5 * math.sqrt(SKETCH * similarity * (1 - similarity)))


def _close(sketches: list[bytes], least: int):
    """Pairs (i, j) of a node whose sketches agree enough, in rows of i."""
    table = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), SKETCH)
    for i in range(len(table) - 1):
        same = (table[i + 1 :] == table[i]).sum(axis=1)
        near = np.flatnonzero(same >= least)
        if len(near):
            yield i, (near + i + 1).tolist()


def _involved(rows: DataFrame, least: int) -> DataFrame:
    """Members of nodes with a close partner that has another label."""

    def run(batches):
        out = []
        for group in runs(batches):
            hit = set()
            labels = [g[2] for g in group]
            for i, near in _close([g[3] for g in group], least):
                others = [j for j in near if labels[j] != labels[i]]
                if others:
                    hit.update(others, [i])
            out += [(group[i][0], group[i][1], labels[i], group[i][3]) for i in hit]
            if len(out) > 10_000:
                yield _batch(out, ["node", "rep", "label", "sketch"])
                out = []
        yield _batch(out, ["node", "rep", "label", "sketch"])

    schema = "node long, rep long, label long, sketch binary"
    return rows.select("node", "rep", "label", "sketch").repartition("node").sortWithinPartitions("node").mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"sketch": pa.binary()}
    return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], kinds.get(n, pa.int64())) for i, n in enumerate(names)})


def _confirmed(rows: DataFrame, least: int, percent: int) -> DataFrame:
    """(a, b): every class with the least class that its node's confirmed links lead to."""

    def run(batches):
        for group in runs(batches):
            out = []
            group = [g for g in {g[1]: g for g in group}.values()]
            root = list(range(len(group)))

            def find(i: int) -> int:
                while root[i] != i:
                    root[i] = i = root[root[i]]
                return i

            first: dict[int, int] = {}
            for i, g in enumerate(group):
                root[i] = first.setdefault(g[2], i)
            sets: dict[int, np.ndarray] = {}
            for i, near in _close([g[3] for g in group], least):
                for j in near:
                    a, b = find(i), find(j)
                    if a == b:
                        continue
                    for k in (i, j):
                        if k not in sets:
                            sets[k] = shingle_set(group[k][4])
                    shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                        root[max(a, b)] = min(a, b)
            lowest: dict[int, int] = {}
            for i, g in enumerate(group):
                r = find(i)
                lowest[r] = min(lowest.get(r, g[1]), g[1])
            out = [(g[1], lowest[find(i)]) for i, g in enumerate(group) if g[1] != lowest[find(i)]]
            if out:
                yield _batch(out, ["a", "b"])

    return (
        rows.select("node", "rep", "label", "sketch", "text").repartition("node").sortWithinPartitions("node").mapInArrow(run, "a long, b long")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable over ``edges`` (a, b), for every node of an edge.

    Large-star and small-star rounds. Neighbours are never gathered: a round takes the least one per node and
    joins it back, so a node with very many links is split like any hot key.
    """

    def star(pairs: DataFrame, small: bool) -> DataFrame:
        both = pairs if small else pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        kept = both.join(stage(least, "least"), "u")
        if small:
            moved = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(kept.select("u", F.col("m").alias("v")))
        else:
            moved = kept.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return stage(moved.filter("u != v").distinct(), "star")

    # u > v in every pair.
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    current, state = stage(pairs, "links"), None
    while True:
        made = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if made == state:
            break
        state = made
        current = star(star(current, False), True)
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stage(roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct(), "components")


def near_duplicates(docs: DataFrame, percent: int = 85, trees: int = TREES, limit: int = NODE) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable) and kept (first of its component)."""
    signed = stage(signatures(docs), "signatures")
    classes = signed.filter("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.any_value("tokens").alias("tokens"), F.any_value("sketch").alias("sketch")
    )
    sets = stage(classes, "sets")
    named = sets.filter("rep is not null")
    small, large = nodes(named, trees, limit)
    large = stage(large, "large_nodes")
    members = stage(_sketched(small.unionByName(pivoted(large, limit)), named), "node_members")
    least = _agreement(percent / 100)
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")

    def linked(rows: DataFrame) -> DataFrame:
        close = stage(_involved(rows, least), "close")
        return stage(_confirmed(_with_texts(close, texts), least, percent), "confirmed")

    links = linked(members.filter("tree = 0").withColumn("label", F.col("rep")))
    labels = stage(links.groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("label")), "labels")
    links = links.unionByName(linked(_labelled(members.filter("tree > 0"), labels)))
    found = components(links)
    if not large.isEmpty():
        labels = found.select(F.col("node").alias("rep"), F.col("component").alias("label"))
        more = linked(_labelled(_sketched(remaining(large, labels, limit), named), labels))
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    of = found.select(F.col("node").alias("rep"), "component")
    named = stage(sets.select("key", "rep").join(of, "rep", "left").select("key", F.coalesce("component", "rep").alias("component_id")), "named")
    return (
        signed.select("doc_id", "n_shingles", "key")
        .join(named, "key", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.equal_null("doc_id", "component_id").alias("kept"))
    )


def _sketched(rows: DataFrame, sets: DataFrame) -> DataFrame:
    return rows.join(sets.select("rep", "sketch"), "rep")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def _with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Node members with their text; only the texts of members move on to the nodes."""
    wanted = stage(rows.select("rep").distinct(), "wanted")
    own = stage(texts.join(wanted, "rep"), "member_texts")
    return rows.join(own, "rep")
