"""Byte-level BPE: overlapping chunk encoding, and decoding by raw bytes.

Short texts are encoded where they are read. A text over ``chunk`` characters is cut into
chunks that overlap by ``overlap``; each is pre-tokenised by itself, in any task. Two
neighbours are stitched at the first place of their overlap where both have a pre-token
boundary: matching goes on alike from a common boundary, whatever came before. The pieces
between these places are encoded in parallel and their ids joined in order.

A boundary of a chunk counts only if its match cannot have looked past the chunk's end, and
only after a character that is no white space, since a piece's end must not change how the
white space before it is split. A text with neighbours that never agree (a pre-token longer
than the overlap) is put together again and encoded whole.

Null text counts as empty and has no ids. Rows are kept as they are: repeated rows, null ids
and ties give a row each. Other columns are ignored.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mealmarts.llm.common import lists, map_batches, parts

CHUNK, OVERLAP = 1 << 15, 512
_LOOK = 3  # characters that one try of the pattern may look ahead without taking them


@functools.lru_cache(4)
def encoding(ranks_file: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(4)
def _token_bytes(ranks_file: str, pattern: str) -> list[bytes]:
    e = encoding(ranks_file, pattern)
    known = set(e._mergeable_ranks.values())
    return [e.decode_single_token_bytes(i) if i in known else b"" for i in range(e.n_vocab)]


def boundaries(text: str, pattern: str, low: int, high: int) -> list[int]:
    """Ends of pre-tokens within [low, high), matching from the start of ``text``."""
    found = []
    for match in regex.compile(pattern).finditer(text):
        if match.end() >= high:
            break
        if match.end() >= low:
            found.append(match.end())
    return found


def _split(chunk: int, overlap: int):
    def run(batch: pa.RecordBatch):
        task, seen = TaskContext.get().partitionId(), {}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            key = f"{task}-{xxhash.xxh3_128_hexdigest(f'{doc_id}:{text}'.encode())}"
            seen[key] = nth = seen.get(key, -1) + 1
            n = -(-len(text) // chunk)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": [f"{key}-{nth}"] * n,
                    "doc_id": pa.array([doc_id] * n, pa.int64()),
                    "k": pa.array(range(n), pa.int32()),
                    "n": pa.array([n] * n, pa.int32()),
                    "chunk": [text[i * chunk : (i + 1) * chunk + overlap] for i in range(n)],
                }
            )

    return run


def _ends(pattern: str, chunk: int, overlap: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        heads, tails = [], []
        for k, n, text in zip(*(batch.column(c).to_pylist() for c in ("k", "n", "chunk"))):
            heads.append(boundaries(text, pattern, 1, overlap) if k else [])
            safe = len(text) - _LOOK + 1 if k < n - 1 else 0
            tails.append([e - chunk for e in boundaries(text, pattern, chunk + 1, safe) if not text[e - 1].isspace()])
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
            names=[*batch.schema.names, "head", "tail"],
        )

    return run


def _encode(ranks_file: str, pattern: str, keep: int):
    """Ids of the last column's texts; the first ``keep`` columns go along."""

    def run(batch: pa.RecordBatch):
        e = encoding(ranks_file, pattern)
        for part in parts(batch, batch.schema.names[-1], 8 << 20):
            ids = [np.asarray(e.encode_ordinary(t or ""), np.int32) for t in part.column(keep).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:keep], lists(ids, pa.int32())], names=[*part.schema.names[:keep], "ids"]
            )

    return run


def encode(docs: DataFrame, ranks_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    is_long = F.coalesce(F.char_length("_text"), F.lit(0)) > chunk
    short = map_batches(rows.filter(~is_long), _encode(ranks_file, pattern, 1), "doc_id long, ids array<int>")

    cut = map_batches(rows.filter(is_long), _split(chunk, overlap), "key string, doc_id long, k int, n int, chunk string")
    ends = map_batches(
        cut.repartition("key", "k"),
        _ends(pattern, chunk, overlap),
        "key string, doc_id long, k int, n int, chunk string, head array<int>, tail array<int>",
    )
    order = Window.partitionBy("key").orderBy("k")
    stitched = (
        ends.withColumn("stop", F.array_min(F.array_intersect("tail", F.lead("head").over(order))))
        .withColumn("begin", F.lag("stop").over(order))
        .withColumn("lost", (F.col("k") < F.col("n") - 1) & F.col("stop").isNull())
        .withColumn("whole", F.max("lost").over(Window.partitionBy("key")))
        .drop("head", "tail", "lost")
    )
    begin, stop = F.coalesce("begin", F.lit(0)), F.coalesce("stop", F.lit(0))
    pieces = stitched.filter("not whole").select(
        "key", "doc_id", "k", F.substring(F.col("chunk"), begin + 1, chunk + stop - begin).alias("piece")
    )
    again = (
        stitched.filter("whole")
        .groupBy("key", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("k", F.substring("chunk", 1, chunk).alias("body")))).alias("all"))
        .select("key", "doc_id", F.lit(0).alias("k"), F.array_join("all.body", "").alias("piece"))
    )
    encoded = map_batches(
        pieces.unionByName(again), _encode(ranks_file, pattern, 3), "key string, doc_id long, k int, ids array<int>"
    )
    joined = (
        encoded.groupBy("key", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("all"))
        .select("doc_id", F.flatten("all.ids").alias("ids"))
    )
    return short.unionByName(joined)


def decode(encoded: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded binary): the ids' raw bytes one after the other."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = _token_bytes(ranks_file, pattern).__getitem__
        column = batch.column(1)
        flat, offsets = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
        texts = [b"".join(map(table, flat[a:b].tolist())) for a, b in zip(offsets[:-1], offsets[1:])]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids, one space between), decoded_sha256."""
    line = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(line.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
