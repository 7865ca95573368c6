"""Exact substring dedup on sorted suffixes (deep-shallow sorting).

A byte goes if it lies in a string of ``WINDOW`` bytes that starts anywhere else too. Suffixes are needed at
anchors only (see ``anchors``): two equal strings have equal anchors at equal offsets. The contexts of one anchor, which differ,
are put in order of what follows the anchor: multikey quicksort on eight bytes at a time down to ``SHALLOW``
bytes, then a blind trie for each group that still agrees. Neighbours' common prefixes make a tree of
intervals; within an interval whose members share ``d`` following bytes, the order of what precedes the
anchor gives everyone's longest common left part ``l`` with another. Where l + d reaches ``WINDOW``, the l bytes before and
the d bytes after the anchor are repeated. This finds every repeated string around the anchor, without comparing pairs.

Contexts that occur twice or more whole are taken whole. An anchor with more than ``SPLIT`` different contexts
is not gathered: the hashes of its strings are counted by Spark instead, with the same result.

Texts are UTF-8 bytes, null counts as empty; what is kept need not be valid UTF-8. Matches never cross texts, and strings
are judged on the input. Rows with the same id and text are one document for repeats between rows, each is cut alike; a null id
is a document too. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.llm import anchors as A
from mealmarts.llm.common import merged, runs
from mealmarts.session import stage

WINDOW, SHALLOW, SPLIT = 200, 64, 100_000
SHAPE = A.Shape("byte", 32, WINDOW)
_CHUNK = 8


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - (((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) >> 3)


class BlindTrie:
    """Trie of branching depths: a search looks at the branching bytes alone, then compares with one leaf."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    def _byte(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):
            node = node[1].get(self._byte(i, node[0])) or next(iter(node[1].values()))
        depth = common_prefix(self.strings[i], self.strings[node[0]])
        if depth == len(self.strings[i]) == len(self.strings[node[0]]):
            node.append(i)
            return
        other = node[0]
        above, key, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            above, key = node, self._byte(i, node[0])
            node = node[1][key]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][self._byte(i, depth)] = [i]
            return
        fork = (depth, {self._byte(other, depth): node, self._byte(i, depth): [i]})
        if above is None:
            self.root = fork
        else:
            above[1][key] = fork

    def ordered(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                out += node
            else:
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Order of the strings."""
    out: list[int] = []
    todo = [(list(range(len(strings))), 0)]
    while todo:
        rows, depth = todo.pop()
        if len(rows) < 2:
            out += rows
        elif depth >= shallow:
            trie = BlindTrie(strings)
            for i in rows:
                trie.insert(i)
            out += trie.ordered()
        else:
            part = {i: strings[i][depth : depth + _CHUNK] for i in rows}
            pivot = sorted((part[rows[0]], part[rows[len(rows) // 2]], part[rows[-1]]))[1]
            less, equal, more = [], [], []
            for i in rows:
                (less if part[i] < pivot else more if part[i] > pivot else equal).append(i)
            ended = len(pivot) < _CHUNK  # then the equal ones are equal to their end
            todo += [(more, depth), *([([i], depth) for i in equal] if ended else [(equal, depth + _CHUNK)]), (less, depth)]
    return out


def shared_extents(befores: list[bytes], afters: list[bytes], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Per context (bytes before the anchor backwards, bytes from the anchor on) its (l, d) with l + d >= ``window``."""
    found: list[list[tuple[int, int]]] = [[] for _ in afters]
    order = deep_shallow(afters)
    depth = np.array([0, *[common_prefix(afters[a], afters[b]) for a, b in zip(order[:-1], order[1:])]])
    rank = [0] * len(befores)
    for place, i in enumerate(deep_shallow(befores)):
        rank[i] = place
    todo = [(0, len(order))]
    while todo:
        low, high = todo.pop()
        if high - low < 2:
            continue
        d = int(depth[low + 1 : high].min())
        members = sorted(order[low:high], key=rank.__getitem__)
        left = [0, *[common_prefix(befores[a], befores[b]) for a, b in zip(members[:-1], members[1:])], 0]
        for i, l, r in zip(members, left[:-1], left[1:]):
            if max(l, r) + d >= window:
                found[i].append((max(l, r), d))
        cuts = [low, *(np.flatnonzero(depth[low + 1 : high] == d) + low + 1).tolist(), high]
        todo += list(zip(cuts[:-1], cuts[1:]))
    return found


def _sorted_spans(around: DataFrame, shape: A.Shape) -> DataFrame:
    """(doc, mark, start, stop) of the repeated strings of contexts that occur once."""

    def run(batches):
        for group in runs(batches):
            ends = [(left, body) for _, _, _, _, left, body in group]
            extents = shared_extents([b[:x][::-1] for x, b in ends], [b[x:] for x, b in ends], shape.window)
            out = []
            for (_, n, doc, at, _, _), found in zip(group, extents):
                if n == 1:
                    out += [(doc, at & A.MARK, (at >> A.MARK_BITS) - l, (at >> A.MARK_BITS) + d) for l, d in found]
            if out:
                names = ["doc", "mark", "start", "stop"]
                yield pa.RecordBatch.from_pydict({c: pa.array([o[i] for o in out], pa.int64()) for i, c in enumerate(names)})

    rows = around.select("anchor", "n", "doc", "at", "left", "body").repartition("anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(run, "doc long, mark long, start long, stop long")


def _counted_spans(around: DataFrame, shape: A.Shape) -> DataFrame:
    """The same for anchors with very many contexts, by counting hashes of their strings."""
    strings = A.windows(around, shape).select("phrase", "doc", "mark", "start")
    place = F.struct("doc", "mark", "start")
    repeated = strings.groupBy("phrase").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a != b").select("phrase")
    return strings.join(repeated, "phrase").select("doc", "mark", "start", (F.col("start") + shape.window).alias("stop"))


def _finish(doc, text, begin, end):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    starts, ends = merged(begin, np.minimum(end, len(raw)))
    kept = np.ones(len(raw), bool)
    for a, b in zip(starts.tolist(), ends.tolist()):
        kept[a:b] = False
    return doc, len(raw), int(len(raw) - kept.sum()), len(starts), raw[kept].tobytes()


def remove_repeats(docs: DataFrame, shape: A.Shape = SHAPE, split: int = SPLIT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of every text."""
    occurring = A.occurrences(docs, shape)
    found = A.classes(occurring)
    suspects = A.suspects(found)
    texts = A.keyed(docs)
    sizes = stage(suspects.groupBy("anchor").count().select("anchor", (F.col("count") > split).alias("many")), "anchor_sizes")
    around = stage(A.contexts(texts, suspects, shape).join(sizes, "anchor"), "contexts")
    some = _sorted_spans(around.filter("not many"), shape).unionByName(_counted_spans(around.filter("many"), shape))
    repeats = found.filter("n > 1").select("anchor", "context")
    whole = occurring.join(repeats, ["anchor", "context"], "left_semi")
    rows = A.with_spans(
        texts, whole, some, shape, _finish,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary",
    )
    return rows


def digests(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
