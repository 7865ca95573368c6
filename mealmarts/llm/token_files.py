"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits. Level 0 holds the low chunk of every id, and a bit that
says whether the id goes on; level 1 holds the next chunk of those that go on, and so forth. A
rank directory counts the set bits before every 512th place of a level, so the place of an id's
next chunk is found at once: any id, or any run of ids, is read without decoding what lies around it.

``write`` range-partitions the texts by doc_id, encodes them in order and writes segments of about
``SEGMENT`` ids as rows of a Parquet folder, through Spark's commit: a lost task leaves nothing
behind. A segment holds whole documents, their places in it, and the levels as raw bytes. A second
small table holds the number of ids before every range. Null ids come first; rows with the same id
are documents of their own, in any order. A null or empty text has the end id only.
"""

from __future__ import annotations

import functools
import json
import os
import re
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mealmarts.llm.common import byte_alphabet, map_batches, parts

SEGMENT, RANK_EVERY, CACHE = 1 << 20, 512, 600_000
_END = "\x01"
# Characters whose normal form is themselves in lower case, each kind a piece of its own (digits one by one). No apostrophe: it may begin a suffix.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = "".join(re.escape(chr(c)) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_PIECE = re.compile(f"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+")
_ODD = re.compile(f"[^{_LETTERS}0-9{_SIGNS}]")
_LEVEL = "struct<chunks:binary,bits:binary,ranks:binary>"
SCHEMA = (
    "range int, segment int, range_offset long, n_ids long, doc_ids array<bigint>, doc_starts array<bigint>, "
    f"levels array<{_LEVEL}>"
)


class Level:
    """One level: chunks, continuation bits (first bit highest) and the rank directory."""

    def __init__(self, chunks: bytes, bits: bytes, ranks: bytes):
        self.chunks = np.frombuffer(chunks, np.uint8)
        self.bits = np.frombuffer(bits, np.uint8)
        self.ranks = np.frombuffer(ranks, "<u8")

    @classmethod
    def of(cls, chunks: np.ndarray, more: np.ndarray) -> Level:
        counts = np.add.reduceat(more.astype(np.uint64), np.arange(0, len(more), RANK_EVERY)) if len(more) else np.empty(0)
        ranks = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
        return cls(chunks.astype(np.uint8).tobytes(), np.packbits(more).tobytes(), ranks.tobytes())

    def rank(self, place: int) -> int:
        """Set bits before ``place``."""
        block = place // RANK_EVERY
        return int(self.ranks[block]) + int(self.more(block * RANK_EVERY, place).sum())

    def more(self, start: int, stop: int) -> np.ndarray:
        first = start // 8
        return np.unpackbits(self.bits[first : -(-stop // 8)])[start - first * 8 : stop - first * 8].astype(bool)

    def parts(self) -> dict[str, bytes]:
        return {"chunks": self.chunks.tobytes(), "bits": self.bits.tobytes(), "ranks": self.ranks.tobytes()}


def encode_levels(ids: np.ndarray) -> list[Level]:
    levels, rest = [], ids.astype(np.uint64)
    while len(rest) or not levels:
        higher = rest >> np.uint64(8)
        more = higher > 0
        levels.append(Level.of(rest & np.uint64(255), more))
        rest = higher[more]
    return levels


def read_ids(levels: list[Level], start: int, n: int) -> np.ndarray:
    """Ids [start, start + n): each level is read only where the run's ids go on."""
    level = levels[0]
    ids = level.chunks[start : start + n].astype(np.uint64)
    more = level.more(start, start + n)
    if n and more.any():
        ids[more] |= read_ids(levels[1:], level.rank(start), int(more.sum())) << np.uint64(8)
    return ids


@functools.lru_cache(2)
def _merges(path: str) -> tuple[tiktoken.Encoding, int]:
    """The vocabulary's merges over bytes, where ``_END`` closes a piece, and the id that a line break has there.

    Ids rank the merges: letters first, then letters at a piece's end, then merges in order.
    """
    letters = byte_alphabet()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ranks = {}
    for token, i in vocabulary.items():
        name, closes = token.removesuffix("</w>"), token.endswith("</w>")
        ranks[bytes(letters[c] for c in name) + _END.encode() * closes] = i
    made = tiktoken.Encoding("pieces", pat_str=rf"[^{_END}\n]+{_END}|\n", mergeable_ranks=ranks, special_tokens={})
    return made, ranks[b"\n"]


@functools.lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a core per task
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class WordEncoder:
    """Encodes each different word once.

    The vocabulary's splitter drops white space and no rule reaches across it, so a text's ids
    are its words' ids in order. Words of Latin letters, digits and ASCII signs, which its normaliser merely lower-cases, are cut
    where it parts letters, digits and signs, and go through the same merges in one call, the end of each piece marked by a
    byte of its own. All other words go to the library one by one, as do those with the string of an added token, which has an id
    of its own wherever it occurs. Beyond ``CACHE`` words, those seen once are dropped.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In any case of letters: tokens may be looked up in normalised text.
        self.whole = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.IGNORECASE)
        self.merges, self.line = _merges(path)
        self.numbers, self.uses = _Numbers(), np.empty(0, np.int64)
        self.ids, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _trim(self) -> None:
        kept = np.flatnonzero(self.uses > 1)
        if 2 * len(kept) > CACHE:
            kept = kept[:0]
        words = list(self.numbers)
        self.numbers = _Numbers((words[i], n) for n, i in enumerate(kept.tolist()))
        self.ids, counts = self._gather(kept)
        self.starts, self.uses = np.concatenate([[0], np.cumsum(counts)]), np.zeros(len(kept), np.int64)

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(counts)
        return self.ids[np.repeat(self.starts[at] - ends + counts, counts) + np.arange(counts.sum())], counts

    def _learn(self, words: list[bytes]) -> None:
        joined = b"\n".join(words).decode()
        lines = joined.split("\n")
        odd = [i for i, w in enumerate(lines) if _ODD.search(w)]
        if self.whole.search(joined):
            odd = sorted({*odd, *(i for i, w in enumerate(lines) if self.whole.search(w))})
        apart = [lines[i] for i in odd]
        for i in odd:
            lines[i] = ""
        pieces = _PIECE.sub("\\g<0>" + _END, "\n".join(lines).lower() + "\n")
        found = np.array(self.merges.encode_ordinary(pieces), np.uint32)
        stops = np.flatnonzero(found == self.line)
        counts = np.diff(np.concatenate([[-1], stops])) - 1
        found = found[found != self.line]
        if odd:
            made = [e.ids for e in self.tokenizer.encode_batch_fast(apart, add_special_tokens=False)]
            at = np.cumsum(counts)[odd]  # odd lines are empty here
            sizes = [len(m) for m in made]
            found = np.insert(found, np.repeat(at, sizes), np.fromiter(chain.from_iterable(made), np.uint32))
            counts[odd] = sizes
        self.ids = np.concatenate([self.ids, found])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        self.uses = np.concatenate([self.uses, np.zeros(len(counts), np.int64)])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.numbers) > CACHE:
            self._trim()
        split = [t.encode().split() if t else [] for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        if len(self.numbers) > len(self.uses):
            self._learn(list(islice(self.numbers, len(self.uses), None)))
        self.uses += np.bincount(at, minlength=len(self.uses))
        flat, counts = self._gather(at)
        ends = np.concatenate([[0], np.cumsum(counts)])
        return np.split(flat, ends[np.cumsum(lengths)[:-1]]) if len(split) else []


@functools.lru_cache(1)
def _encoder(path: str) -> WordEncoder:
    """One per Python worker: what it has learned serves the worker's next tasks."""
    return WordEncoder(path)


def _segments(tokenizer: str, end_id: int, segment_ids: int):
    def run(batches):
        encoder, task = _encoder(tokenizer), TaskContext.get().partitionId()
        docs, held, number, offset = [], [], 0, 0

        def close():
            nonlocal docs, held, number, offset
            ids = np.concatenate(held)
            starts = np.cumsum([0, *map(len, held)])[:-1]
            row = {
                "range": task, "segment": number, "range_offset": offset, "n_ids": len(ids),
                "doc_ids": docs, "doc_starts": starts.tolist(), "levels": [x.parts() for x in encode_levels(ids)],
            }
            docs, held, number, offset = [], [], number + 1, offset + len(ids)
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        size = 0
        for batch in batches:
            for part in parts(batch, "text", 8 << 20):
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                    docs.append(doc_id)
                    held.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    if size >= segment_ids:
                        yield close()
                        size = 0
        if docs:
            yield close()

    return run


_ARROW = pa.schema(
    [
        ("range", pa.int32()), ("segment", pa.int32()), ("range_offset", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())),
        ("levels", pa.list_(pa.struct([(n, pa.binary()) for n in ("chunks", "bits", "ranks")]))),
    ]
)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, segment_ids: int = SEGMENT) -> None:
    """Encode ``docs`` (doc_id, text) to ``path``/segments and ``path``/ranges, in ascending doc_id order."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(_segments(tokenizer, end_id, segment_ids), SCHEMA).write.parquet(f"{path}/segments")
    # One row per task of the write.
    ranges = spark.read.schema(SCHEMA).parquet(f"{path}/segments").groupBy("range").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ranges.select("range", F.coalesce(before, F.lit(0)).alias("start"), "n").write.parquet(f"{path}/ranges")


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("range int, start long, n long").parquet(f"{path}/ranges")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Segments of a folder that ``write`` made, with ``start``: the ids before the segment."""
    segments = spark.read.schema(SCHEMA).parquet(f"{path}/segments")
    return segments.join(_ranges(spark, path).drop("n"), "range").withColumn("start", F.col("start") + F.col("range_offset"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary: little-endian unsigned 32-bit) of every document, from the files."""

    def run(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            levels = [Level(**x) for x in row["levels"]]
            starts = [*row["doc_starts"], row["n_ids"]]
            sizes = [b - a for a, b in zip(starts[:-1], starts[1:])]
            ids = [read_ids(levels, a, n).astype("<u4").tobytes() for a, n in zip(starts, sizes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array([row["start"] + a for a in starts[:-1]], pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"],
            )

    kept = read(spark, path).select("start", "n_ids", "doc_ids", "doc_starts", "levels")
    return map_batches(kept, run, "doc_id long, start long, n_tokens long, ids binary")


def slice_segments(spark: SparkSession, path: str, start: int, n: int) -> DataFrame:
    """(start, n_ids, levels) of the segments that overlap ids [start, start + n).

    The ranges that overlap come first; they and the bounds within them reach the scan of the segments as literals.
    """
    stop = start + n
    hits = _ranges(spark, path).filter((F.col("start") < stop) & (F.col("start") + F.col("n") > start)).collect()  # as many as the slice spans
    segments = spark.read.schema(SCHEMA).parquet(f"{path}/segments")
    found = None
    for hit in hits:
        inside = (F.col("range") == hit.range) & (F.col("range_offset") < stop - hit.start)
        overlap = segments.filter(inside & (F.col("range_offset") + F.col("n_ids") > start - hit.start))
        one = overlap.select((F.col("range_offset") + hit.start).alias("start"), "n_ids", "levels")
        found = one if found is None else found.unionByName(one)
    return found if found is not None else segments.select(F.col("range_offset").alias("start"), "n_ids", "levels").limit(0)


def read_slice(spark: SparkSession, path: str, start: int, n: int) -> DataFrame:
    """(place, id) of the ids [start, start + n): only the segments that overlap are opened."""

    def run(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            low, high = max(start - row["start"], 0), min(start + n - row["start"], row["n_ids"])
            ids = read_ids([Level(**x) for x in row["levels"]], low, high - low)
            places = pa.array(np.arange(low, high) + row["start"], pa.int64())
            yield pa.RecordBatch.from_arrays([places, pa.array(ids.astype(np.int64))], names=["place", "id"])

    return map_batches(slice_segments(spark, path, start, n), run, "place long, id long")


def digests(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
