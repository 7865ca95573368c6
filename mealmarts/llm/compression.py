"""Quality classifier by compression: zstandard dictionaries of good and bad text, and a calibrated score.

A text is compressed with a dictionary of good and with one of bad labelled texts; the sign of the difference of
the sizes says which it is like. That is done for two views of the text: its bytes, and its shape, in which letters
and digits are one symbol per class, so that layout and casing count whatever the language. Texts are compressed in
blocks of ``BLOCK`` bytes and sizes summed, so that a dictionary weighs the same in short and in long texts. Per view the
normalised difference (bad - good) / (bad + good) and the logarithms of both sizes against the text's, together
with the text's length, go through a logistic fit to a score of 0 to 1.

Fitting uses a bounded sample: per label at most ``DOCS`` documents for each of dictionaries and calibration, chosen by
a hash of the text among at most ``PICKS`` labelled ids, and at most ``BYTES`` of pieces for a dictionary, spread evenly over
long texts. Calibration weighs each label by its share among all labelled rows. Everything else covers all rows.

Null counts as the empty text, which has a score like any other. A label other than 0 and 1 is none; of several labels of one id the
lowest counts. With one label alone every score is that label, without any 0.5. A dictionary for which there is too little text to train
holds the text itself. Repeated rows are rows like any other; null ids are never learned from; other columns are ignored.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.llm.common import lists, map_batches, parts
from mealmarts.operators.ranking import top_n
from mealmarts.session import stage

PICKS, DOCS, BYTES = 20_000, 2_000, 4 << 20
DICTIONARY, PIECE, BLOCK, LEVEL = 16 << 10, 1 << 10, 4 << 10, 3
RIDGE, STEPS = 0.1, 40

_LETTERS = bytes(range(97, 123)) + bytes(range(128, 256))
_SHAPE = bytes.maketrans(
    _LETTERS + bytes(range(65, 91)) + bytes(range(48, 58)), b"a" * len(_LETTERS) + b"A" * 26 + b"0" * 10
)
VIEWS = ("bytes", "shape")


def view(text: bytes, name: str) -> bytes:
    return text if name == "bytes" else text.translate(_SHAPE)


class Model(NamedTuple):
    dictionaries: tuple[tuple[bytes, bytes], ...]  # per view: good, bad; as made by ``build``
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the features, and a constant
    fixed: float | None = None  # the score of everything where there was nothing to tell apart


def build(texts: list[bytes], size: int = DICTIONARY, limit: int = BYTES) -> bytes:
    """A trained dictionary of pieces of the texts; the end of the joined pieces if they are too few."""
    share = max(PIECE, limit // max(1, len(texts)))
    pieces = []
    for text in texts:
        places = range(0, len(text), PIECE)
        pieces += [text[i : i + PIECE] for i in places[:: max(1, -(-len(text) // max(share, PIECE * 4)))]]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:] or b"\n"


@functools.lru_cache(8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(dictionary)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def sizes(text: bytes, dictionaries: tuple[tuple[bytes, bytes], ...]) -> list[int]:
    """Compressed size per view and dictionary, over all blocks of the whole text."""
    out = []
    for name, pair in zip(VIEWS, dictionaries):
        seen = view(text, name)
        blocks = [seen[i : i + BLOCK] for i in range(0, len(seen), BLOCK)] or [b""]
        out += [sum(len(compress(b)) for b in blocks) for compress in (_compressor(d).compress for d in pair)]
    return out


def features(length: np.ndarray, compressed: np.ndarray) -> np.ndarray:
    """Per view: normalised difference, and both sizes against the length; then the length."""
    room = np.log(length + 20.0)
    columns = []
    for v in range(compressed.shape[1] // 2):
        good, bad = compressed[:, 2 * v], compressed[:, 2 * v + 1]
        columns += [(bad - good) / (bad + good), np.log(good) - room, np.log(bad) - room]
    return np.stack([*columns, room], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps: centre, scale, weights."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[(x - centre) / scale, np.ones(len(x))]
    ridge, w = np.eye(a.shape[1]) * RIDGE, np.zeros(a.shape[1])
    for _ in range(STEPS):
        p = _sigmoid(a @ w)
        slope = a.T @ (weight * (y - p)) - ridge @ w
        w += np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + ridge, slope)
    return centre, scale, w


def _measure(texts: list[str], dictionaries) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in texts]
    return np.array([len(t) for t in data], np.int64), np.array([sizes(t, dictionaries) for t in data], np.int64)


def train(docs: DataFrame, labels: DataFrame, picks: int = PICKS, docs_each: int = DOCS) -> Model:
    """Fit on ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) marks with 0 or 1."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))
    picked = top_n(marks, ["label"], [F.xxhash64("doc_id"), F.col("doc_id")], picks, "_n").drop("_n")
    found = rows.join(F.broadcast(picked), "doc_id")  # at most 2 * picks rows of two numbers
    # The part is chosen by the text, so that copies are all learned from or all held back.
    found = found.withColumn("part", F.pmod(F.xxhash64("_text", F.lit(1)), F.lit(2)).cast("int"))
    sample = stage(
        top_n(found, ["label", "part"], [F.xxhash64("_text", F.lit(2)), F.col("doc_id")], docs_each, "_n").drop("_n"), "label-sample"
    )
    counts = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}  # two rows

    def dictionaries(frame: pd.DataFrame) -> pd.DataFrame:  # at most docs_each texts, and pieces of them
        texts = [t.encode() for t in frame["_text"]]
        made = [build([view(t, v) for t in texts]) for v in VIEWS]
        return pd.DataFrame({"label": frame["label"].iloc[:1], "made": [made]})

    ordered = sample.filter("part = 0").select("label", "_text")
    made = {r.label: [bytes(d) for d in r.made] for r in ordered.groupBy("label").applyInPandas(dictionaries, "label int, made array<binary>").collect()}
    if set(made) != {0, 1}:
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return Model((), np.zeros(0), np.zeros(0), np.zeros(0), share if counts else 0.5)
    pairs = tuple(zip(made[1], made[0]))

    def measure(batch: pa.RecordBatch):
        for part in parts(batch, "_text", 8 << 20):
            lengths, found = _measure(part.column(1).to_pylist(), pairs)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lengths), lists(list(found), pa.int64())], names=["label", "n_bytes", "sizes"])

    def rows_of(chosen: DataFrame) -> list:  # at most 2 * docs_each rows of numbers, 4 * docs_each of both parts
        return sorted(map_batches(chosen.select("label", "_text"), measure, "label int, n_bytes long, sizes array<long>").collect())

    measured = rows_of(sample.filter("part = 1"))
    if {r.label for r in measured} != {0, 1}:  # too few for two parts: both from all of them
        measured = rows_of(sample)
    y = np.array([r.label for r in measured], float)
    x = features(np.array([r.n_bytes for r in measured], float), np.array([r.sizes for r in measured], float))
    share = np.array([counts[0] / max(1, (y == 0).sum()), counts[1] / max(1, (y == 1).sum())])
    weight = share[y.astype(int)]
    return Model(pairs, *fit(x, y, weight * len(y) / weight.sum()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_bytes, sizes, score) for every row; score is the calibrated probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: four dictionaries and eight numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))
    if model.fixed is not None:
        return rows.select(
            "doc_id", F.octet_length("_text").cast("long").alias("n_bytes"), F.array().cast("array<long>").alias("sizes"),
            F.lit(model.fixed).alias("score"),
        )

    def run(batch: pa.RecordBatch):
        model = shared.value
        for part in parts(batch, "_text", 8 << 20):
            lengths, found = _measure(part.column(1).to_pylist(), model.dictionaries)
            x = features(lengths.astype(float), found.astype(float))
            p = _sigmoid(np.c_[(x - model.centre) / model.scale, np.ones(len(x))] @ model.weights)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lengths), lists(list(found), pa.int64()), pa.array(p)],
                names=["doc_id", "n_bytes", "sizes", "score"],
            )

    return map_batches(rows, run, "doc_id long, n_bytes long, sizes array<long>, score double")
