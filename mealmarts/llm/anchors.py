"""Places where documents may share a passage, found without comparing documents.

A text is a row of units (words or bytes). Of every ``window`` consecutive units the run of ``gram`` units with
the least hash is the window's anchor (the leftmost of equal ones). Equal windows have equal anchors at
equal offsets, so only windows around anchors that recur can recur. About one unit in half a window is
an anchor; nothing else is shuffled.

An occurrence of an anchor carries a hash of its context, all units that a window with this anchor can
reach. Occurrences with the same anchor and context are a class: what one shares, all share. A window has
``half`` further units to the left of its anchor or to the right, so a class can share a window with
another class only if one of these half contexts recurs too; the other classes are done with.

Documents are known by (doc, mark): their id and 32 bits of their text's hash. Texts without an id have 61 more bits of the hash
for an id, all below any real one. So rows of one id and one text are one document here, all others are told apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mealmarts.llm.common import hashed_words, leftmost_minima, map_batches, mixed, words
from mealmarts.session import stage

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
BLOCK = 1 << 18  # units handled at once
NO_ID = -(1 << 63)
MARK_BITS = 32  # of ``at``, below the place
MARK = (1 << MARK_BITS) - 1


class Shape(NamedTuple):
    unit: str  # "word" or "byte"
    gram: int
    window: int

    @property
    def half(self) -> int:
        return (self.window - self.gram + 1) // 2

    @property
    def before(self) -> int:
        """Units before an anchor that its windows can reach; after its start they reach ``window``."""
        return self.window - self.gram


_OF_BYTE = mixed(np.arange(256, dtype=np.uint64) + _STEP)


def units(shape: Shape, texts: list[str | bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A random-looking 64-bit number for every unit of the texts, one text after the other; and how many each has."""
    raws = [t if isinstance(t, bytes) else (t or "").encode() for t in texts]
    if shape.unit == "byte":
        return _OF_BYTE[np.frombuffer(b"".join(raws), np.uint8)], np.array(list(map(len, raws)), np.int64)
    return hashed_words(raws)


class _Hashes:
    """Hash of any run of units, from prefix sums over powers of an odd base."""

    powers = inverses = np.empty(0, np.uint64)

    def __init__(self, values: np.ndarray):
        n = len(values) + 1
        if len(_Hashes.powers) < n:
            for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
                row = np.full(max(n, 4096), base, np.uint64)
                row[0] = 1
                setattr(_Hashes, name, np.cumprod(row, dtype=np.uint64))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values * self.powers[: n - 1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.inverses[start] + (stop - start).astype(np.uint64) * _STEP)

    def all(self, n: int) -> np.ndarray:
        """Of every ``n`` consecutive units."""
        count = len(self.sums) - n
        if count <= 0:
            return np.empty(0, np.uint64)
        return mixed((self.sums[n:] - self.sums[:count]) * self.inverses[:count])


class Found(NamedTuple):
    text: np.ndarray  # number of the text
    place: np.ndarray
    anchor: np.ndarray
    context: np.ndarray
    halves: np.ndarray  # left in the high 32 bits, right in the low; 0 where the text is too short for it

    def chosen(self, rows: np.ndarray) -> Found:
        return Found(*[column[rows] for column in self])


def anchors(texts: list[np.ndarray], shape: Shape, details: bool) -> Found:
    """Anchors of some texts (their units), with contexts if ``details``. The texts stand one after the other here."""
    sizes = np.array([len(t) for t in texts], np.int64)
    values = np.concatenate(texts) if len(texts) > 1 else texts[0]
    hashes = _Hashes(values)
    grams = hashes.all(shape.gram)
    owner = np.repeat(np.arange(len(texts)), sizes)
    end = np.cumsum(sizes)
    # A text's last gram starts this far before its end.
    place = leftmost_minima(grams, shape.window - shape.gram + 1, end[owner[: len(grams)]] - shape.gram + 1)
    anchor, text = grams[place], owner[place]
    stop = end[text]
    start = stop - sizes[text]
    if not details:
        return Found(text, place - start, anchor, anchor, anchor)
    context = hashes(np.maximum(place - shape.before, start), np.minimum(place + shape.window, stop))
    left = hashes(np.maximum(place - shape.half, start), place) >> np.uint64(32)
    right = hashes(place, np.minimum(place + shape.gram + shape.half, stop)) >> np.uint64(32)
    left = np.where(place - shape.half >= start, left | np.uint64(1), np.uint64(0))
    right = np.where(place + shape.gram + shape.half <= stop, right | np.uint64(1), np.uint64(0))
    return Found(text, place - start, anchor, context, (left << np.uint64(32)) | right)


def _units_by_text(texts: list[str | None], shape: Shape) -> Iterator[np.ndarray]:
    """Units of each text, those of some ``BLOCK`` characters made in one go."""
    ends, done = np.cumsum([len(t or "") for t in texts]), 0
    while done < len(texts):
        limit = BLOCK + (ends[done - 1] if done else 0)
        stop = max(done + 1, int(np.searchsorted(ends, limit, "right")))
        values, sizes = units(shape, texts[done:stop])
        yield from np.split(values, np.cumsum(sizes)[:-1])
        done = stop


def anchors_by_block(texts: list[str | None], shape: Shape, details: bool) -> Iterator[Found]:
    """Anchors of all texts: short ones together, a text beyond ``BLOCK`` units in parts that share their edges."""
    held, numbers, count = [], [], 0

    def flush() -> Found:
        found = anchors(held, shape, details)
        return found._replace(text=np.array(numbers)[found.text])

    for i, values in enumerate(_units_by_text(texts, shape)):
        if held and count + len(values) > BLOCK:
            yield flush()
            held, numbers, count = [], [], 0
        if len(values) <= BLOCK:
            held.append(values)
            numbers.append(i)
            count += len(values)
            continue
        for begin in range(0, len(values), BLOCK):
            low = max(0, begin - 2 * shape.window)
            found = anchors([values[low : begin + BLOCK + 2 * shape.window]], shape, details)
            place = found.place + low
            found = found._replace(text=found.text + i, place=place)
            yield found.chosen((place >= begin) & (place < begin + BLOCK))
    if held:
        yield flush()


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, mark, text) of every row."""
    text, own = F.coalesce("text", F.lit("")), F.col("doc_id").cast("long")
    unnamed = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text, F.lit(1)), 3)
    return docs.select(
        own.alias("doc_id"), F.coalesce(own, unnamed).alias("doc"), F.xxhash64(text).bitwiseAND(F.lit(MARK)).alias("mark"), "text"
    )


def mark_of(at: str = "at") -> Column:
    return F.col(at).bitwiseAND(F.lit(MARK)).alias("mark")


def occurrences(docs: DataFrame, shape: Shape) -> DataFrame:
    """(anchor, context, halves, doc, at) of the anchors that recur; ``at`` is the place, then the mark. Staged."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for found in anchors_by_block(batch.column(0).to_pylist(), shape, False):
            anchor, n = np.unique(found.anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    def detail(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc, mark = (np.array(batch.column(c).to_pylist(), np.int64) for c in (0, 1))
        for found in anchors_by_block(batch.column(2).to_pylist(), shape, True):
            columns = [found.anchor, found.context, found.halves, doc[found.text], (found.place << MARK_BITS) | mark[found.text]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.view(np.int64)) for c in columns], names=["anchor", "context", "halves", "doc", "at"]
            )

    counted = map_batches(docs.select("text"), count, "anchor long, n long")
    recurring = stage(counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "anchors")
    detailed = map_batches(keyed(docs).select("doc", "mark", "text"), detail, "anchor long, context long, halves long, doc long, at long")
    return stage(detailed.join(recurring, "anchor"), "occurrences")


def classes(occurring: DataFrame) -> DataFrame:
    """(anchor, context, halves, n, doc, at): the first occurrence of every class. Staged."""
    first = F.min(F.struct("doc", mark_of(), "at")).alias("first")
    grouped = occurring.groupBy("anchor", "context").agg(first, F.count("*").alias("n"), F.min("halves").alias("halves"))
    return stage(grouped.select("anchor", "context", "halves", "n", "first.doc", "first.at"), "classes")


def suspects(found: DataFrame) -> DataFrame:
    """Classes with a half context that another class of their anchor has too. Staged."""
    sides = F.array(
        F.struct(F.lit("l").alias("side"), F.shiftrightunsigned("halves", 32).alias("half")),
        F.struct(F.lit("r").alias("side"), F.col("halves").bitwiseAND(F.lit(0xFFFFFFFF)).alias("half")),
    )
    sided = found.select("anchor", "context", F.explode(sides).alias("s")).filter("s.half != 0")
    sided = sided.select(F.xxhash64("anchor", "s.side", "s.half").alias("key"), "anchor", "context")
    shared = stage(sided.groupBy("key").count().filter("count > 1").select("key"), "halves")
    named = stage(sided.join(shared, "key").select("anchor", "context").distinct(), "named")
    return stage(found.join(named, ["anchor", "context"]), "suspects")


def contexts(texts: DataFrame, wanted: DataFrame, shape: Shape) -> DataFrame:
    """The units around the first occurrence of each class in ``wanted``: ``left`` of them precede the anchor.

    (anchor, context, n, doc, at, left, body binary); words are joined by one space. ``texts`` as ``keyed``.
    """
    places = wanted.groupBy("doc", mark_of()).agg(
        F.collect_list(F.struct("anchor", "context", "n", "at")).alias("places")  # of one document
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, text, places in zip(*(c.to_pylist() for c in batch.columns)):
            parts = words(text) if shape.unit == "word" else (text or "").encode()
            for p in places:
                place = p["at"] >> MARK_BITS
                start = max(0, place - shape.before)
                body = parts[start : place + shape.window]
                rows.append((p["anchor"], p["context"], p["n"], doc, p["at"], place - start, b" ".join(body) if shape.unit == "word" else body))
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
        columns = zip(*rows) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=CONTEXT)

    joined = texts.join(places, ["doc", "mark"]).select("doc", "text", "places")
    return map_batches(joined, run, "anchor long, context long, n long, doc long, at long, left int, body binary")


def windows(around: DataFrame, shape: Shape) -> DataFrame:
    """(phrase, doc, start, mark, at) of the windows that have the context's anchor for their own.

    A phrase is told apart by its anchor.
    """

    return map_batches(around, lambda batch: own_windows(batch, shape), "phrase long, doc long, start long, mark long, at long")


def own_windows(batch: pa.RecordBatch, shape: Shape) -> pa.RecordBatch:
    """``windows`` of a batch of contexts, all at once: they stand one after the other, with a row of places around each anchor."""
    anchor, doc, at, left = (batch.column(c).to_numpy() for c in ("anchor", "doc", "at", "left"))
    values, sizes = units(shape, batch.column("body").to_pylist())
    hashes = _Hashes(values)
    grams, phrases = hashes.all(shape.gram), hashes.all(shape.window)
    begin, left = np.cumsum(sizes) - sizes, left.astype(np.int64)
    own, far = (begin + left)[:, None], np.arange(1, shape.before + 1)
    # Back to the last gram before the anchor that is as small, and on to the first after it that is smaller.
    before = (grams[np.maximum(own - far, 0)] <= grams[own]) & (far <= left[:, None])
    after = (grams[np.minimum(own + far, len(grams) - 1)] < grams[own]) & (far <= (sizes - shape.gram - left)[:, None])
    low = np.where(before.any(1), left - before.argmax(1), 0)
    high = np.minimum(np.where(after.any(1), left + after.argmax(1) - shape.before, left), sizes - shape.window)
    count = np.maximum(high + 1 - low, 0)
    row = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + low[row]  # in the context
    phrase = mixed(phrases[begin[row] + place] ^ anchor[row].view(np.uint64)).view(np.int64)
    columns = [phrase, doc[row], ((at >> MARK_BITS) - left)[row] + place, at[row] & MARK, at[row]]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["phrase", "doc", "start", "mark", "at"])


CONTEXT = ["anchor", "context", "n", "doc", "at", "left", "body"]


def spans_of(whole: DataFrame, some: DataFrame) -> DataFrame:
    """(doc, mark, places, spans): per document every place and span once, however many rows and copies give it."""
    none, bounds = F.lit(None).cast("long"), F.struct("start", "stop")
    rows = whole.select("doc", mark_of(), F.shiftright("at", MARK_BITS).alias("place"), F.lit(None).cast("struct<start:bigint,stop:bigint>").alias("span"))
    rows = rows.unionByName(some.select("doc", "mark", none.alias("place"), bounds.alias("span")))
    return rows.groupBy("doc", "mark").agg(F.collect_set("place").alias("places"), F.collect_set("span").alias("spans"))


def with_spans(texts: DataFrame, whole: DataFrame, some: DataFrame, shape: Shape, finish: Callable, schema: str) -> DataFrame:
    """``finish(doc_id, text, starts, ends)`` for every text, with the union of its spans in units.

    ``whole`` (doc, at): occurrences whose full context is taken. ``some`` (doc, mark, start, stop): further spans.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc_id, text, places, spans in zip(*(batch.column(c) for c in ("doc_id", "text", "places", "spans"))):
            place = np.asarray(places.values.to_numpy() if places.is_valid else [], np.int64)
            start, stop = ((spans.values.field(i).to_numpy() if spans.is_valid else np.empty(0, np.int64)) for i in (0, 1))
            begin = np.concatenate([np.maximum(place - shape.before, 0), start])
            end = np.concatenate([place + shape.window, stop])
            out.append(finish(doc_id.as_py(), text.as_py(), begin, end))
        fields = [f.split() for f in schema.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*out), fields)], names=[n for n, _ in fields]
        )

    return map_batches(texts.join(spans_of(whole, some), ["doc", "mark"], "left"), run, schema)
