"""Alignment of two tokenizers by inverted pair bitmaps.

Every text is encoded by a byte-level BPE (A, of a space and the text) and by a piece model (B, of the text).
Byte offsets where a token of both ends cut them into groups. Two tokens are linked where their byte ranges
overlap: between two neighbouring ends, of either side, lies the overlap of exactly one pair, so a
document has as many links as it has different ends.

``align`` inverts the links. Documents get places in containers of up to ``CONTAINER`` documents of one task. Per pair
of ids a container holds a bitmap of the documents with the pair, as bits or as sorted 16-bit places, whichever is
shorter, and planes of bits, one bit per document of the bitmap, that spell by how many links beyond one it has.
Batches of a task are OR-merged into its container. Containers of a pair share no document, so the popcount of all its
containers OR-ed is the sum of theirs (``pair_counts``), and links are counted on the planes alike. ``score`` brings the counts
to the containers and adds them up per document there, so no posting is ever a row.

A container ends at ``LIMIT`` (pair, document) entries or ``CONTAINER`` documents: that bounds a task's memory beside one
batch of texts. A pair that occurs everywhere has a row per container.

Texts that are null or empty, or that one of the tokenizers does not give back byte by byte, have no tokens: zeros and
an empty digest. Repeated rows and null ids are documents of their own. Other columns are ignored. An
empty table gives no row.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.llm.common import byte_alphabet, parts
from mealmarts.session import stage

CONTAINER, LIMIT = 1 << 16, 1 << 22
SHIFT = 32  # a pair is the A id above, the B id below

_FOUND = (
    "container long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, n_docs int, width int, docs binary, planes binary"
)
_TYPES = [
    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
    pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(),
]
_SCHEMA = pa.schema([pa.field(c.split()[0], t) for c, t in zip(_FOUND.split(", "), _TYPES)])


class Pair(NamedTuple):
    """Both tokenizers in a worker: encoders, the bytes of every id, their lengths, and ids as text with what follows them."""

    a: tiktoken.Encoding
    b: sentencepiece.SentencePieceProcessor
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    marks: list[str]


@functools.lru_cache(2)
def load(a_file: str, pattern: str, b_file: str) -> Pair:
    """``a_file``: a byte-level vocabulary whose ids are its merge ranks; its special tokens stay out, so they are plain text."""
    letters = byte_alphabet()
    with open(a_file, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
    a = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=b_file)
    a_bytes = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        a_bytes[i] = token
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    marks = [f"{i}{s}" for n, ends in ((len(a_bytes), ",|"), (len(b_bytes), ",;")) for i in range(n) for s in ends]
    return Pair(a, b, a_bytes, b_bytes, *(np.array([len(t) for t in x], np.int64) for x in (a_bytes, b_bytes)), marks)


class Links(NamedTuple):
    """Of some documents: per document its counts, per link its document and ids, and all tokens in order of their groups."""

    n_groups: np.ndarray
    n_links: np.ndarray
    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray
    marks: np.ndarray


def link(a: list[list[int]], b: list[list[int]], pair: Pair) -> Links:
    """Groups and links of documents whose tokens of both kinds have the same bytes; all stand one after the other."""
    flat = [np.fromiter((i for ids in x for i in ids), np.int64, sum(map(len, x))) for x in (a, b)]
    ends = [np.cumsum(s[f]) for s, f in zip((pair.a_sizes, pair.b_sizes), flat)]
    doc_end = ends[0][np.cumsum([len(ids) for ids in a]) - 1]
    every = np.sort(np.concatenate(ends), kind="stable")
    again = every[1:] == every[:-1]
    cuts, every = every[1:][again], every[np.r_[True, ~again]]
    group = [np.searchsorted(cuts, e) for e in ends]
    last = [cuts[g] == e for g, e in zip(group, ends)]
    sizes = [np.bincount(g, minlength=len(cuts)) for g in group]
    # A group's A tokens stand before its B tokens.
    at_a = np.arange(len(flat[0])) + (np.cumsum(sizes[1]) - sizes[1])[group[0]]
    at_b = np.arange(len(flat[1])) + np.cumsum(sizes[0])[group[1]]
    marks = np.empty(len(flat[0]) + len(flat[1]), np.int64)
    marks[at_a] = 2 * flat[0] + last[0]
    marks[at_b] = 2 * len(pair.a_bytes) + 2 * flat[1] + last[1]
    doc = np.searchsorted(doc_end, every)
    of_a, of_b = (f[np.searchsorted(e, every)] for f, e in zip(flat, ends))
    return Links(np.bincount(np.searchsorted(doc_end, cuts), minlength=len(a)), np.bincount(doc, minlength=len(a)), doc, of_a, of_b, marks)


def _fill(total: int, places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bytes in which the given bits are set, each at most once."""
    return np.bincount(places, weights=1 << bits, minlength=total)[:total].astype(np.uint8)


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def pack(keys: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Pairs, documents per pair, bitmaps and planes of sorted keys (pair, 16-bit place) with their numbers of links.

    A bitmap has ``width`` bytes; shorter ones are lists of places.
    """
    pair, place = keys >> 16, keys & 0xFFFF
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(keys) else np.empty(0, np.int64)
    n = np.diff(np.r_[first, len(keys)])
    row = np.repeat(np.arange(len(first)), n)
    rank = np.arange(len(keys)) - first[row]
    listed = 2 * n < width
    at = _offsets(np.where(listed, 2 * n, width))
    in_list = listed[row]
    byte = at[row] + np.where(in_list, 2 * rank, place >> 3)
    data = _fill(at[-1], byte[~in_list], place[~in_list] & 7)
    data[byte[in_list]] = place[in_list] & 0xFF
    data[byte[in_list] + 1] = place[in_list] >> 8
    more = counts - 1
    levels = np.ceil(np.log2(np.maximum.reduceat(more, first) + 1.0)).astype(np.int64) if len(first) else first
    stride = (n + 7) // 8
    plane_at = _offsets(levels * stride)
    spots, bits = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for level in range(int(levels.max(initial=0))):
        on = (more >> level) & 1 > 0
        spots.append((plane_at[row] + level * stride[row] + (rank >> 3))[on])
        bits.append(rank[on] & 7)
    planes = _fill(plane_at[-1], np.concatenate(spots), np.concatenate(bits))
    return pair[first], n, _binary(at, data), _binary(plane_at, planes)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def unpack(n: np.ndarray, width: np.ndarray, docs: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and links of every entry of some rows of ``pack``, in no order of rows."""
    at, data = _bytes_of(docs)
    listed = 2 * n < width
    rows = np.flatnonzero(listed)
    row = np.repeat(rows, n[rows])
    rank = np.arange(len(row)) - np.repeat(np.cumsum(n[rows]) - n[rows], n[rows])
    byte = at[row] + 2 * rank
    found = [(row, rank, data[byte].astype(np.int64) | data[byte + 1].astype(np.int64) << 8)]
    for i in np.flatnonzero(~listed).tolist():
        place = np.flatnonzero(np.unpackbits(data[at[i] : at[i + 1]], bitorder="little"))
        found.append((np.full(len(place), i), np.arange(len(place)), place))
    row, rank, place = (np.concatenate(x) for x in zip(*found))
    at, data = _bytes_of(planes)
    stride = (n + 7) // 8
    levels = (at[1:] - at[:-1]) // np.maximum(stride, 1)
    links = np.ones(len(row), np.int64)
    for level in range(int(levels.max(initial=0))):
        has = np.flatnonzero(levels[row] > level)
        spot = at[row[has]] + level * stride[row[has]] + (rank[has] >> 3)
        links[has] += (data[spot].astype(np.int64) >> (rank[has] & 7) & 1) << level
    return row, place, links


class _Container:
    """Entries of up to ``CONTAINER`` documents, OR-merged over batches."""

    def __init__(self, number: int):
        self.number, self.n_docs, self.n_entries, self.keys, self.counts = number, 0, 0, [], []

    def add(self, pairs: np.ndarray, places: np.ndarray) -> None:
        keys, counts = np.unique(pairs << 16 | places, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.n_entries += len(keys)

    def rows(self, n_b: int) -> Iterator[pa.RecordBatch]:
        if not self.n_entries:
            return
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys)
        width = -(-self.n_docs // 8)
        pair, n, docs, planes = pack(keys[order], counts[order], width)
        whole = (pair // n_b) << SHIFT | pair % n_b
        made = {"container": np.full(len(n), self.number), "pair": whole, "n_docs": n, "width": np.full(len(n), width)}
        batch = _batch(len(n), **made, docs=docs, planes=planes)
        for at in range(0, len(n), 20_000):
            yield batch.slice(at, 20_000)


def _batch(n: int, **columns) -> pa.RecordBatch:
    arrays = [
        columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
        for f in _SCHEMA
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def align(docs: DataFrame, a_file: str, pattern: str, b_file: str, container: int = CONTAINER, limit: int = LIMIT) -> DataFrame:
    """Two kinds of rows, staged: documents (container, place, doc_id, counts, groups_sha256) and postings (container, pair, n_docs, width, docs, planes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(a_file, pattern, b_file)
        n_b, base = len(pair.b_bytes), TaskContext.get().partitionId() << 32
        held = _Container(base)
        for batch in batches:
            for part in parts(batch, "_text", 4 << 20):
                for at in range(0, part.num_rows, container):
                    rows = part.slice(at, container)
                    if held.n_docs + rows.num_rows > container or held.n_entries >= limit:
                        yield from held.rows(n_b)
                        held = _Container(held.number + 1)
                    yield _documents(rows, pair, held)
        yield from held.rows(n_b)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))
    return stage(rows.mapInArrow(run, _FOUND), "aligned")


def _documents(rows: pa.RecordBatch, pair: Pair, held: _Container) -> pa.RecordBatch:
    texts = rows.column(1).to_pylist()
    a, b, kept = [], [], []
    for i, text in enumerate(texts):
        if text:
            whole = " " + text
            ids_a, ids_b, data = pair.a.encode_ordinary(whole), pair.b.encode(text), whole.encode()
            if b"".join([pair.a_bytes[t] for t in ids_a]) == data and b"".join([pair.b_bytes[t] for t in ids_b]) == data:
                a.append(ids_a)
                b.append(ids_b)
                kept.append(i)
    n = len(texts)
    counts, digests = np.zeros((4, n), np.int64), [""] * n
    if kept:
        found, at = link(a, b, pair), 0
        of = np.array(kept)
        counts[:, of] = [[len(x) for x in a], [len(x) for x in b], found.n_groups, found.n_links]
        marks = found.marks.tolist()
        for i, ids_a, ids_b in zip(kept, a, b):
            stop = at + len(ids_a) + len(ids_b)
            line = "".join([pair.marks[m] for m in marks[at:stop]])
            digests[i], at = hashlib.sha256(line[:-1].encode()).hexdigest(), stop
        held.add(found.a * len(pair.b_bytes) + found.b, held.n_docs + of[found.doc])
    places = np.arange(held.n_docs, held.n_docs + n)
    held.n_docs += n
    names = ("n_a", "n_b", "n_groups", "n_links")
    return _batch(
        n, container=np.full(n, held.number), place=places, doc_id=rows.column(0), groups_sha256=digests, **dict(zip(names, counts))
    )


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, pair, count, is_best): documents with each pair; whether no pair of its A id has more."""
    counts = found.filter("pair is not null").groupBy("pair").agg(F.sum("n_docs").cast("long").alias("count"))
    counts = stage(counts.withColumn("a", F.shiftright("pair", SHIFT)), "pair-counts")
    best = counts.groupBy("a").agg(F.max("count").alias("best"))  # an A id has at most as many pairs as there are B ids
    return counts.join(best, "a").select(
        "a", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)).alias("b"), "pair", "count", (F.col("count") == F.col("best")).alias("is_best")
    )


def pair_links(found: DataFrame) -> DataFrame:
    """(pair, n_links): links of every pair over all documents, counted on the planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, width = (batch.column(i).to_numpy().astype(np.int64) for i in (1, 2))
            row, _, links = unpack(n, width, batch.column(3), batch.column(4))
            sums = np.bincount(row, weights=links, minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums)], names=["pair", "n_links"])

    rows = found.filter("pair is not null").select("pair", "n_docs", "width", "docs", "planes")
    return rows.mapInArrow(run, "pair long, n_links long").groupBy("pair").agg(F.sum("n_links").alias("n_links"))


def score(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every document.

    Postings and counts meet by a sort-merge join at any size, as the pairs may be as many as both vocabularies allow.
    A container's postings, each with its pair's count, meet its documents in one task: at most ``LIMIT`` entries and a batch.
    """
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"

    def finish(docs: list[pa.RecordBatch], sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        for batch in docs:
            places = batch.column("place").to_numpy()
            made = [*(batch.column(c) for c in names), *(pa.array(s[places]) for s in sums)]
            yield pa.RecordBatch.from_arrays(made, names=[*names, "n_best", "count_sum"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, sums = None, [], None
        for batch in batches:
            containers = batch.column("container").to_numpy()
            edges = np.r_[0, np.flatnonzero(np.diff(containers)) + 1, len(containers)]
            for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if start == stop:
                    continue
                if containers[start] != held:
                    yield from finish(docs, sums)
                    held, docs, sums = containers[start], [], np.zeros((2, CONTAINER), np.int64)
                rows = batch.slice(start, stop - start)
                is_doc = rows.column("pair").is_null()
                if rows.column("pair").null_count:
                    docs.append(rows.filter(is_doc).select(["place", *names]))
                rows = rows.filter(pc.invert(is_doc))
                if rows.num_rows:
                    n, width, count, best = (rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n_docs", "width", "count", "is_best"))
                    row, place, links = unpack(n, width, rows.column("docs"), rows.column("planes"))
                    np.add.at(sums[0], place, links * best[row])
                    np.add.at(sums[1], place, links * count[row])
        yield from finish(docs, sums)

    postings = found.filter("pair is not null").join(counts.select("pair", "count", "is_best").hint("merge"), "pair")
    both = postings.select("container", "pair", "n_docs", "width", "docs", "planes", "count", "is_best").unionByName(
        found.filter("pair is null").select("container", "place", *names), allowMissingColumns=True
    )
    return both.repartition("container").sortWithinPartitions("container").mapInArrow(run, kinds)
