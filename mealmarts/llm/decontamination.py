"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item leaks into a document if the document holds 80 % or more of the item's distinct
five-word shingles (A-Z lower-cased, words between ASCII white space). Items are short and
documents long, so plain MinHash similarity is near zero for a true leak; what is estimated is
containment in the item, and its sketch alone is looked up in the document.

Items are partitioned by size: class ``c`` holds items of [2^c, 2^(c+1)) shingles. The class settles
the sketch and two bounds. The sketch is the shingle of least hash in each of a number of buckets that
grows with the class, at least ``SKETCH``, never more than the item's shingles. A document with fewer
shingles than 80 % of 2^c is not looked up in the class. Others are candidates if they hold ``needed``
of the item's sketch shingles: of an item sketched whole the 80 % themselves, so no leak escapes; of
others as many as a leak of 80 % misses with a probability below ``MISS``. Candidates are verified on
the exact shingles as text.

The sketches are a table. Below ``SMALL`` rows (its size is counted) every task holds them; beyond,
documents' shingle hashes and sketches meet in a join. Both give the same candidates.

Null or empty texts, and items under five words, have no shingle and match nothing. Repeated items
or documents give a row each; a null id is kept as null. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.llm.common import gram_hashes, map_batches, text_key, word_hashes
from mealmarts.session import stage

SHINGLE, SHARE, SKETCH, SMALL = 5, 0.8, 16, 200_000
MISS = 1e-9


def _words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []  # bytes.lower is A-Z only


def shingles(text: str | None) -> set[bytes]:
    w = _words(text)
    return {b" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}


def hashes(text: str | None) -> np.ndarray:
    return np.unique(gram_hashes(word_hashes(_words(text)), SHINGLE))


def sketch(values: np.ndarray, least: int = SKETCH) -> np.ndarray:
    """One least hash per bucket; ``least`` buckets, doubled with each size class beyond 2^8 shingles."""
    size = len(values)
    if size <= least:
        return values
    buckets = least << max(0, int(math.log2(size)) - 8)
    bucket = (values >> np.uint64(20)) % np.uint64(buckets)
    first = np.unique(bucket, return_index=True)[1]  # values ascend, so the first of a bucket is its least
    return values[first] if len(first) >= least // 2 else values[:least]


def size_class(size: int) -> int:
    return size.bit_length() - 1


def least_held(c: int, share: float) -> int:
    """Shingles that a document needs to hold ``share`` of any item of class ``c``."""
    return math.ceil(share * (1 << c) - 1e-9)


@functools.cache
def needed(sketched: int, whole: bool, share: float) -> int:
    """Sketch shingles that a candidate must hold, one at least."""
    if whole:
        return max(1, math.ceil(share * sketched - 1e-9))
    below, need = (1 - share) ** sketched, 1
    while need < sketched:
        below += math.comb(sketched, need) * share**need * (1 - share) ** (sketched - need)
        if below > MISS:
            break
        need += 1
    return need


def _sketches(items: DataFrame, share: float) -> DataFrame:
    """(item_id, item, size_class, sketch, need) per item with a shingle."""

    def run(batch: pa.RecordBatch):
        out = []
        for item_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            values = hashes(text)
            if len(values):
                made = sketch(values)
                need = needed(len(made), len(made) == len(values), share)
                out.append((item_id, text, size_class(len(values)), made.view(np.int64).tolist(), need))
        yield pa.RecordBatch.from_pydict(
            {
                "item_id": pa.array([o[0] for o in out], pa.int64()),
                "item": pa.array([o[1] for o in out], pa.string()),
                "size_class": pa.array([o[2] for o in out], pa.int32()),
                "sketch": pa.array([o[3] for o in out], pa.list_(pa.int64())),
                "need": pa.array([o[4] for o in out], pa.int32()),
            }
        )

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item"))
    schema = "item_id long, item string, size_class int, sketch array<long>, need int"
    return stage(map_batches(rows, run, schema), "sketches")


_PAIRS = "doc_id long, item_id long, n_shared long, n_item long"


def _pairs_out(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "item_id", "n_shared", "n_item"]
    return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})


def _verified(doc_id, text: str, items: list[tuple], share: float):
    held = shingles(text)
    for item_id, own in items:
        shared = len(own & held)
        if shared >= share * len(own):
            yield doc_id, item_id, shared, len(own)


def _search_held(docs: DataFrame, found: DataFrame, share: float) -> DataFrame:
    """All sketches in every task: a sorted array per size class answers which of a document's hashes are in one."""
    spark = docs.sparkSession
    rows = found.select("item_id", "item", "size_class", "sketch", "need").collect()  # below SMALL sketch shingles
    items = [(r.item_id, r.item, r.need) for r in rows]
    classes: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for i, r in enumerate(rows):
        for h in r.sketch:
            classes[r.size_class][h].append(i)
    sizes = [(least_held(c, share), dict(of)) for c, of in sorted(classes.items())]
    shared = spark.sparkContext.broadcast((items, sizes))

    def run(batches):
        items, sizes = shared.value
        sizes = [(least, np.sort(np.array(list(of), np.int64).view(np.uint64)), of) for least, of in sizes]
        # Most hashes stop at a bit table; the others are looked for among the keys of each class.
        bits = np.zeros(1 << 24, bool)
        for _, keys, _ in sizes:
            bits[(keys >> np.uint64(40)).astype(np.int64)] = True
        own: dict[int, set[bytes]] = {}
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = gram_hashes(word_hashes(_words(text)), SHINGLE)
                places = len(values)  # as many distinct shingles or fewer
                values = np.unique(values[bits[(values >> np.uint64(40)).astype(np.int64)]])
                near = []
                for least, keys, of in sizes if len(values) else ():
                    if least > places:
                        break
                    held = Counter(i for v in values[np.isin(values, keys)].view(np.int64).tolist() for i in of[v])
                    near += [i for i, n in held.items() if n >= items[i][2]]
                for i in near:
                    if i not in own:
                        own[i] = shingles(items[i][1])
                out += _verified(doc_id, text, [(items[i][0], own[i]) for i in near], share) if near else ()
            yield _pairs_out(out)

    return docs.mapInArrow(run, _PAIRS)


def _search_joined(docs: DataFrame, found: DataFrame, share: float) -> DataFrame:
    """Hashes of documents and sketches meet in a join, within the size classes open to a document; then texts and
    items per candidate."""

    def exploded(batch: pa.RecordBatch):
        for key, text in zip(*(c.to_pylist() for c in batch.columns)):
            values = hashes(text).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(values), pa.binary()), pa.array(values), pa.array([len(values)] * len(values), pa.int64())],
                names=["key", "h", "size"],
            )

    def verify(batch: pa.RecordBatch):
        out = []
        for doc_id, text, items in zip(*(c.to_pylist() for c in batch.columns)):
            out += _verified(doc_id, text, [(i["item_id"], shingles(i["item"])) for i in items], share)
        yield _pairs_out(out)

    # Equal texts are one text until the end.
    keyed = stage(found.withColumn("n", F.monotonically_increasing_id()), "numbered_sketches")
    probes = stage(keyed.select("n", "size_class", "need", F.explode("sketch").alias("h")), "probes")
    texts = docs.groupBy(text_key().alias("key")).agg(F.any_value("text").alias("text"))
    least = F.ceil(F.lit(share) * F.pow(F.lit(2.0), F.col("size_class")) - 1e-9)
    near = (
        map_batches(texts, exploded, "key binary, h long, size long")
        .join(probes, "h")
        .filter(F.col("size") >= least)
        .groupBy("key", "n", "need")
        .agg(F.count("*").alias("held"))
        .filter("held >= need")
    )
    # A text has as many candidates as items share a shingle with it; they travel in slices.
    slices = (
        near.join(keyed.select("n", "item_id", "item"), "n")
        .groupBy("key", F.pmod(F.hash("n"), F.lit(64)).alias("slice"))
        .agg(F.collect_list(F.struct("item_id", "item")).alias("items"))
    )
    rows = docs.withColumn("key", text_key()).join(stage(slices, "candidates"), "key")
    return map_batches(rows.select("doc_id", "text", "items"), verify, _PAIRS)


def leaks(docs: DataFrame, items: DataFrame, share: float = SHARE, small: int = SMALL) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) for every document that holds ``share`` of an item's shingles."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = _sketches(items, share)
    size = found.agg(F.coalesce(F.sum(F.size("sketch")), F.lit(0)), F.coalesce(F.sum(F.length("item")), F.lit(0))).first()
    if size[0] <= small and size[1] <= 200 * small:
        return _search_held(rows, found, share)
    return _search_joined(rows, found, share)
