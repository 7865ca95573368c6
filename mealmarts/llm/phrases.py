"""Substring dedup by repeated-phrase automata.

A phrase is ``WINDOW`` consecutive words. Windows around recurring anchors (see ``anchors``) whose word
sequence occurs twice or more are the confirmed phrases, each with its first occurrence (least doc_id, then
place). They are dealt to shards by their anchor, a shard of some ten thousand phrases compiles an Aho-Corasick
automaton over word numbers, and the documents' contexts stream through the automata of the
anchors they hold. Every occurrence that is not the first is taken out, overlaps as one. A context that
equals an earlier one has no first occurrence and is taken whole, without a search.

An anchor with very many contexts has its contexts dealt to several shards and its phrases given to each.

Null or empty texts have no words. Rows with the same id and text are one document and lose the same words;
a null id is the least. Texts under ``WINDOW`` words lose nothing. Other columns are ignored.
"""

from __future__ import annotations


from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.llm import anchors as A
from mealmarts.llm.common import merged, words
from mealmarts.session import stage

WINDOW = 20
SHAPE = A.Shape("word", 5, WINDOW)
SHARD, SPLIT = 20_000, 20_000  # phrases per automaton, contexts per anchor and shard


def confirmed(around: DataFrame, shape: A.Shape = SHAPE) -> DataFrame:
    """(doc, at, starts): first occurrences of the sequences found twice, by the context they lie in."""
    repeated = A.windows(around, shape).groupBy("phrase").agg(
        F.min(F.struct("doc", "mark", "start", "at")).alias("first"), F.max(F.struct("doc", "mark", "start")).alias("last")
    )
    again = F.struct("first.doc", "first.mark", "first.start") != F.col("last")
    return repeated.filter(again).groupBy("first.doc", "first.at").agg(F.collect_list("first.start").alias("starts"))


def _automaton(phrases: list[tuple]) -> tuple[ahocorasick.Automaton, Callable]:
    """The automaton, and what writes words as its letters, two to a word.

    A node's letters are searched one by one, and the root has one for every first word. So a word's number is a high and
    a low letter, of which a node has some hundreds at most; they differ, so matches begin and end with words.
    """
    letters: dict[bytes, str] = {}
    automaton = ahocorasick.Automaton()
    for sequence, first in phrases:
        for word in sequence:
            if word not in letters:
                high, low = divmod(len(letters), 256)
                letters[word] = chr(257 + high) + chr(1 + low)
        automaton.add_word("".join([letters[w] for w in sequence]), first)
    automaton.make_automaton()
    return automaton, lambda sequence: "".join([letters.get(w, "\0\0") for w in sequence])


def located(around: DataFrame, firsts: DataFrame, shape: A.Shape = SHAPE) -> DataFrame:
    """(doc, mark, start, stop): occurrences, other than the first, of confirmed phrases in the contexts."""
    sizes = stage(around.groupBy("anchor").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("parts")), "anchor_parts")
    total = firsts.agg(F.coalesce(F.sum(F.size("starts")), F.lit(0))).first()[0]
    shards = max(12, -(-total // SHARD))

    def shard(part):
        return F.pmod(F.xxhash64("anchor", part.cast("long")), F.lit(shards)).cast("int").alias("shard")

    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    compiled = (
        around.join(firsts, ["doc", "at"])
        .join(sizes, "anchor")
        .select("*", every)
        .select(shard(F.col("part")), F.lit(0).alias("kind"), "doc", "at", "left", "body", "starts")
    )
    streamed = around.join(sizes, "anchor").select(
        shard(F.pmod(F.xxhash64("context"), F.col("parts"))), F.lit(1).alias("kind"), "doc", "at", "left", "body",
        F.lit(None).cast("array<long>").alias("starts"),
    )

    def run(batches):
        own, phrases, automaton, written = None, [], None, None
        for batch in batches:
            out = []
            for shard, kind, doc, at, left, body, starts in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != own:
                    own, phrases, automaton = shard, [], None
                sequence, begin = body.split(), (at >> A.MARK_BITS) - left
                if kind == 0:
                    mark = at & A.MARK
                    phrases += [(sequence[s - begin : s - begin + shape.window], (doc, mark, s)) for s in starts]
                    continue
                if phrases:
                    automaton, written = _automaton(phrases)
                    phrases = []
                if automaton is None:
                    continue
                mark, low, high = at & A.MARK, 0, -1
                for end, first in automaton.iter(written(sequence)):  # ends ascend
                    start = begin + end // 2 - shape.window + 1
                    if first != (doc, mark, start):
                        if start > high:
                            if high >= 0:
                                out.append((doc, mark, low, high))
                            low = start
                        high = start + shape.window
                if high >= 0:
                    out.append((doc, mark, low, high))
            names = ["doc", "mark", "start", "stop"]
            yield pa.RecordBatch.from_pydict({n: pa.array([o[i] for o in out], pa.int64()) for i, n in enumerate(names)})

    dealt = compiled.unionByName(streamed).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(run, "doc long, mark long, start long, stop long")


def _finish(doc, text, begin, end):
    tokens = words(text)
    starts, ends = merged(begin, np.minimum(end, len(tokens)))
    kept, at = [], 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        kept += tokens[at:a]
        at = b
    kept += tokens[at:]
    line = b" ".join(kept)
    return doc, len(tokens), len(tokens) - len(kept), line.decode()


def remove_repeats(docs: DataFrame, shape: A.Shape = SHAPE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every text without the words of repeated phrases, joined by one space."""
    occurring = A.occurrences(docs, shape)
    found = A.classes(occurring)
    texts = A.keyed(docs)
    around = stage(A.contexts(texts, A.suspects(found), shape), "contexts")
    firsts = stage(confirmed(around, shape), "phrases")
    some = located(around, firsts, shape)
    repeats = found.filter("n > 1").select("anchor", "context", F.col("doc").alias("first_doc"), F.col("at").alias("first_at"))
    later = occurring.join(repeats, ["anchor", "context"]).filter("doc != first_doc or at != first_at")
    return A.with_spans(texts, later, some, shape, _finish, "doc_id long, n_words long, n_removed long, kept string")


def digests(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
