"""Helpers of the training-data operators: words, hashes, Arrow batches, classes of equal texts."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


_SHIPPED: set[str] = set()

#: Texts are long rows: what a Python worker holds at once is bounded by bytes, not by ten thousand rows.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python of the application's executors, once, and bound the batches they get."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / package.name
        context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin stands for itself, the rest follows from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than ASCII white space (space, tab to carriage return); null has none."""
    return text.encode().split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, so that all bits of a sum of products are usable."""
    x = (x ^ (x >> np.uint64(32))) * _STEP
    x = (x ^ (x >> np.uint64(32))) * _STEP
    return x ^ (x >> np.uint64(32))


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LONG = 64  # bytes of a word
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_SEEDS = mixed(np.arange(_LONG + 1, dtype=np.uint64) * _MIX + _STEP)


def hashed_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (as ``words``) of some texts, one text after the other; and how many each has.

    Eight bytes of all words at a time; longer words than ``_LONG`` each by itself.
    """
    blob = b" ".join([b"", *raws, bytes(8)])
    data = np.frombuffer(blob, np.uint8)[: len(blob) - 8]
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1  # white space stands at both ends
    start, stop = edges[::2], edges[1::2]
    size = stop - start
    eight = np.ndarray(len(blob) - 7, "<u8", blob, strides=(1,))
    values = mixed(_SEEDS[np.minimum(size, _LONG)] ^ (eight[start] & _MASKS[np.minimum(size, 8)]))
    rest, done = np.flatnonzero((size > 8) & (size <= _LONG)), 8
    while len(rest):
        values[rest] = mixed(values[rest] ^ (eight[start[rest] + done] & _MASKS[np.minimum(size[rest] - done, 8)]))
        done += 8
        rest = rest[size[rest] > done]
    for i in np.flatnonzero(size > _LONG).tolist():
        values[i] = xxhash.xxh3_64_intdigest(blob[start[i] : stop[i]])
    ends = np.cumsum([len(r) + 1 for r in raws])
    return values, np.diff(np.searchsorted(start, ends), prepend=0)


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every ``n`` consecutive values, in order; empty if there are fewer."""
    count = len(values) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total = total * _MIX + mixed(values[i : i + count].astype(np.uint64) + _STEP)
    return mixed(total)


def leftmost_minima(keys: np.ndarray, width: int, ends: np.ndarray | None = None) -> np.ndarray:
    """Positions that are the leftmost smallest key of some ``width`` consecutive keys, ascending.

    Running minima to both sides of every ``width``-th place give each window's smallest key, whatever
    the width. A place in the lowest bits settles ties to the left. ``ends``: per key, where its row of
    keys ends, if several rows stand one after the other; a window lies in one row.
    """
    n = len(keys)
    if n < width:
        return np.empty(0, np.int64)
    bits = np.uint64(max(1, (width - 1).bit_length()))
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys >> bits << bits
    blocks = padded.reshape(-1, width)
    blocks |= np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(n - width + 1)
    if ends is not None:
        start = start[start + width <= ends[start]]
    last = start + (width - 1)
    left, right = back[start], ahead[last]
    low = (np.uint64(1) << bits) - np.uint64(1)
    at_left = left >> bits <= right >> bits
    found = np.where(at_left, start - start % width + (left & low).astype(np.int64), last - last % width + (right & low).astype(np.int64))
    # Windows advance by one, so equal places stand together.
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as maximal spans, ascending."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([first[1:], [True]])
    return starts[first], ends[last]


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Numpy rows as one Arrow list column."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` for a function of one batch, which returns or yields batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                if isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made

    return df.mapInArrow(run, schema)


def parts(batch: pa.RecordBatch, column: str, limit: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose ``column`` holds about ``limit`` bytes, a row at least."""
    offset, n = 0, batch.num_rows
    ends = np.cumsum([len(x) if x is not None else 0 for x in map(_buffer, batch.column(column))])
    done = 0
    while offset < n:
        stop = max(offset + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(offset, stop - offset)
        offset, done = stop, int(ends[stop - 1])


def _buffer(value: pa.Scalar):
    return value.as_buffer()


def text_key(text: str = "text"):
    """Identity of a text (null counts as empty): 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def runs(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[list[tuple]]:
    """Rows of sorted batches in groups of equal first ``keys`` columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held
