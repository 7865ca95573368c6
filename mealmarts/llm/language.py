"""Language identification with spans of mixed-language text.

Training counts character trigrams (hashed to ``BUCKETS``) and letters per script for every
language, over all rows given. Each word's script narrows its candidates to the languages in which
that script makes up ``SCRIPT_SHARE`` of the letters or more; if there is none, all stay. A word
scores a candidate by the smoothed log-likelihood of its trigrams. Viterbi over a text's words, at
``SWITCH`` for a change of language, labels every word; runs of one label are the spans. The
text's language is the one with the most letters, the score its share of them.

The counts are summed per language and bucket by Spark. What reaches the driver and the tasks is one
array of fixed size per language, so it grows with the number of languages alone.

A text that is null or has no letter, or any text if nothing was learned, is ``und`` with score 0
and no span. Ties go to the first language by name. Repeated rows are rows like any other; other
columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.llm.common import map_batches, mixed

BUCKETS, SCRIPT_SHARE, SWITCH, SMOOTH = 1 << 16, 0.01, 14.0, 0.5
BLOCK = 500_000  # characters scored at once, one text at least

# Script ranges of Unicode blocks (first, last code point, script).
RANGES = [
    (0x41, 0x24F, "latin"), (0x250, 0x2AF, "latin"), (0x1E00, 0x1EFF, "latin"), (0x370, 0x3FF, "greek"),
    (0x1F00, 0x1FFF, "greek"), (0x400, 0x52F, "cyrillic"), (0x530, 0x58F, "armenian"), (0x590, 0x5FF, "hebrew"),
    (0x600, 0x77F, "arabic"), (0x900, 0x97F, "devanagari"), (0x980, 0x9FF, "bengali"), (0xA00, 0xA7F, "gurmukhi"),
    (0xA80, 0xAFF, "gujarati"), (0xB80, 0xBFF, "tamil"), (0xC00, 0xC7F, "telugu"), (0xC80, 0xCFF, "kannada"),
    (0xD00, 0xD7F, "malayalam"), (0xE00, 0xE7F, "thai"), (0x10A0, 0x10FF, "georgian"), (0x1100, 0x11FF, "hangul"),
    (0xAC00, 0xD7AF, "hangul"), (0x3040, 0x309F, "kana"), (0x30A0, 0x30FF, "kana"), (0x3400, 0x9FFF, "han"),
]
SCRIPTS = ["other", *dict.fromkeys(name for _, _, name in RANGES)]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point of the first plane: lower-case form if it is a letter or mark, else 0; script."""
    fold, script = np.zeros(0x10000, np.uint32), np.zeros(0x10000, np.uint8)
    for c in range(0x10000):
        if unicodedata.category(chr(c))[0] in "LM":
            low = chr(c).lower()
            fold[c] = ord(low) if len(low) == 1 else c
    for first, last, name in RANGES:
        script[first : last + 1] = SCRIPTS.index(name)
    return fold, script


_FOLD, _SCRIPT = _tables()


class Words(NamedTuple):
    """The lettered words of some texts: code points, and per word its text, place and script."""

    grams: np.ndarray  # hashed trigrams, in order
    first: np.ndarray  # of each word's trigrams
    text: np.ndarray
    start: np.ndarray  # code points within the text
    stop: np.ndarray
    letters: np.ndarray
    script: np.ndarray


def split(texts: list[str | None]) -> Words:
    """Words are runs of letters; a trigram reaches from a blank before to a blank after the word."""
    joined = "\n".join(["", *[t or "" for t in texts], ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum([1, *[len(t or "") + 1 for t in texts]])[:-1]
    inside = points < 0x10000
    low = np.where(inside, _FOLD[np.where(inside, points, 0)], 0)
    astral = np.flatnonzero(~inside)
    low[astral] = [c if unicodedata.category(chr(c))[0] == "L" else 0 for c in points[astral].tolist()]
    is_letter = low > 0
    edge = np.flatnonzero(np.diff(is_letter.astype(np.int8)))
    start, stop = edge[::2] + 1, edge[1::2] + 1
    wide = low.astype(np.uint64)
    at = np.flatnonzero(is_letter)  # the middle letter of each trigram
    grams = mixed((wide[at - 1] << np.uint64(42)) | (wide[at] << np.uint64(21)) | wide[at + 1]) % np.uint64(BUCKETS)
    text = np.searchsorted(begins, start, "right") - 1
    letters = stop - start
    first = np.cumsum(letters) - letters
    script = np.where(points[start] < 0x10000, _SCRIPT[np.where(points[start] < 0x10000, points[start], 0)], 0)
    return Words(grams.astype(np.int64), first, text, start - begins[text], stop - begins[text], letters, script)


def blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= BLOCK):
            size += len(texts[stop] or "")
            stop += 1
        yield at, texts[at:stop]
        at = stop


class Model(NamedTuple):
    langs: list[str]
    weights: np.ndarray  # (BUCKETS, languages): log-likelihood of a trigram
    allowed: np.ndarray  # (scripts, languages)


def train(docs: DataFrame) -> Model:
    """Fit on every row of ``docs`` (text, lang) whose lang is not null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for at, texts in blocks(batch.column(0).to_pylist()):
                found = split(texts)
                names = langs[at : at + len(texts)]
                known = {n: i for i, n in enumerate(dict.fromkeys(names))}
                of_word = np.array([known[n] for n in names], np.int64)[found.text]
                width = BUCKETS + len(SCRIPTS)
                counts = np.bincount(np.repeat(of_word, found.letters) * width + found.grams, minlength=len(known) * width)
                counts += np.bincount(of_word * width + BUCKETS + found.script, found.letters, len(known) * width).astype(np.int64)
                for n, row in zip(known, counts.reshape(len(known), width)):
                    sums[n] = sums.get(n, 0) + row
        for n, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(at), pa.string()), pa.array(at), pa.array(row[at])], names=["lang", "at", "n"])

    rows = docs.filter("lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    table = rows.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))

    def dense(frame: pd.DataFrame) -> pd.DataFrame:  # at most BUCKETS rows and the scripts
        row = np.zeros(BUCKETS + len(SCRIPTS))
        row[frame["at"]] = frame["n"]
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "row": [row.tobytes()]})

    made = sorted(table.groupBy("lang").applyInPandas(dense, "lang string, row binary").collect())
    if not made:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    counts = np.array([np.frombuffer(r.row) for r in made])
    grams, scripts = counts[:, :BUCKETS] + SMOOTH, counts[:, BUCKETS:]
    weights = np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32)
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model([r.lang for r in made], np.ascontiguousarray(weights), (share >= SCRIPT_SHARE).T)


def word_scores(found: Words, model: Model) -> np.ndarray:
    """(words, languages): log-likelihood, minus infinity outside the candidates of the word's script."""
    scores = np.add.reduceat(model.weights[found.grams], found.first, axis=0)
    allowed = model.allowed[found.script]
    allowed[~allowed.any(axis=1)] = True
    return np.where(allowed, scores, -np.inf)


def viterbi(scores: np.ndarray, text: np.ndarray, n_texts: int, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word. All texts of a block advance together, a word at a time.

    Only the best language's total and the stay totals matter for the next word, as every change costs the same.
    """
    lengths = np.bincount(text, minlength=n_texts)
    begins = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    steps = int(lengths[0]) if n_texts else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts longer than the step
    total = scores[begins[: active[0]]].astype(np.float64) if steps else None
    stayed = np.ones(scores.shape, bool)
    best = np.zeros(len(scores), np.int32)  # at a word: the best language up to the word before
    labels = np.zeros(len(scores), np.int32)
    for step in range(1, steps):
        n = active[step]
        total, at = total[:n], begins[:n] + step
        top = total.argmax(axis=1)
        change = total[np.arange(n), top][:, None] - switch
        stay = total >= change
        stayed[at], best[at] = stay, top
        total = np.where(stay, total, change) + scores[at]
        done = n if step + 1 == steps else active[step + 1]
        ended = begins[done:n] + step
        labels[ended] = total[done:n].argmax(axis=1)
        if step + 1 == steps:
            labels[at] = total.argmax(axis=1)
    if steps:
        single = begins[: active[0]][lengths[: active[0]] == 1]
        labels[single] = scores[single].argmax(axis=1)
    for step in range(steps - 1, 0, -1):
        at = begins[: active[step]] + step
        labels[at - 1] = np.where(stayed[at, labels[at]], labels[at], best[at])
    return labels


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))


def label(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """(doc_id, lang_pred, score, spans of code points with their language) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size per language

    def run(batch: pa.RecordBatch):
        model = shared.value
        # By length, so that texts of a block end together and a long one holds up few.
        texts = batch.column(1).to_pylist()
        order = sorted(range(len(texts)), key=lambda i: len(texts[i] or ""))
        doc_ids = batch.column(0).take(pa.array(order))
        for at, texts in blocks([texts[i] for i in order]):
            n, langs = len(texts), model.langs
            pred, score, spans = ["und"] * n, [0.0] * n, [[] for _ in range(n)]
            found = split(texts) if langs else None
            if found is not None and len(found.text):
                labels = viterbi(word_scores(found, model), found.text, n, switch)
                sums = np.bincount(found.text * len(langs) + labels, found.letters, n * len(langs)).reshape(n, -1)
                whole, top = sums.sum(axis=1), sums.argmax(axis=1)
                for i in np.flatnonzero(whole):
                    pred[i], score[i] = langs[top[i]], float(sums[i, top[i]] / whole[i])
                new = np.flatnonzero(np.r_[True, (np.diff(found.text) != 0) | (np.diff(labels) != 0)])
                last = np.r_[new[1:], len(labels)] - 1
                for a, b in zip(new.tolist(), last.tolist()):
                    spans[found.text[a]].append({"start": int(found.start[a]), "stop": int(found.stop[b]), "lang": langs[labels[a]]})
            yield pa.RecordBatch.from_arrays(
                [doc_ids.slice(at, n), pa.array(pred), pa.array(score, pa.float64()), pa.array(spans, _SPANS)],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, run, "doc_id long, lang_pred string, score double, spans array<struct<start:int,stop:int,lang:string>>")
