"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of one key (equal texts) are a group and never part. Groups are summed by Spark. A group
heavier than a ``PACK``-th part of the whole is a pack of its own; lighter ones are packed first
where they lie, each task taking its groups from the largest down and putting each into the
fullest open pack with room, found in an ordered tree of remaining capacities. That leaves some thousands of packs
at any size of the data (at most twice ``PACK`` and one more per task), and the same method puts them into
shards: of a fixed capacity, as few as it takes, or of the least capacity for which a given number will do (bisection).

Null and empty text have the size 1 and are one group. Equal sizes go by key. Repeated rows and null ids are rows like
any other, with slots of their own. No shard is left out; with few groups some are empty. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.llm.common import text_key
from mealmarts.operators.ranking import number_rows
from mealmarts.session import stage

PACK = 2048


class OpenBins:
    """Bins ordered by remaining capacity, in leaves of a two-level balanced tree."""

    def __init__(self, leaf: int = 256):
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.least: list[tuple[int, int]] = [(0, 0)]  # smallest entry that the leaf may hold
        self.leaf = leaf

    def add(self, room: int, number: int) -> None:
        at = max(0, bisect_left(self.least, (room, number + 1)) - 1)
        insort(self.leaves[at], (room, number))
        if len(self.leaves[at]) > self.leaf:
            half = len(self.leaves[at]) // 2
            right = self.leaves[at][half:]
            del self.leaves[at][half:]
            self.leaves.insert(at + 1, right)
            self.least.insert(at + 1, right[0])

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (room, number) with the least room that is ``size`` or more."""
        at = max(0, bisect_left(self.least, (size, 0)) - 1)
        while at < len(self.leaves):
            place = bisect_left(self.leaves[at], (size, -1))
            if place < len(self.leaves[at]):
                return self.leaves[at].pop(place)
            at += 1
        return None


def best_fit(sizes: Iterable[int], capacity: int) -> list[int]:
    """Bin of every size, taken in the given (descending) order. A size above the capacity fills a bin alone."""
    open_bins, out, n = OpenBins(), [], 0
    for size in sizes:
        found = open_bins.take_tightest(size)
        room, number = found if found else (max(capacity, size), n)
        n += found is None
        out.append(number)
        if room > size:
            open_bins.add(room - size, number)
    return out


def least_capacity(sizes: list[int], bins: int) -> list[int]:
    """Best fit into at most ``bins`` bins of the least capacity that bisection finds. ``sizes`` descend."""
    low = max([-(-sum(sizes) // bins), *sizes[:1]])
    high = low * 2 + 1
    best = best_fit(sizes, high)
    while max(best, default=0) >= bins:
        high *= 2
        best = best_fit(sizes, high)
    while low < high:
        mid = (low + high) // 2
        tried = best_fit(sizes, mid)
        if max(tried, default=0) < bins:
            best, high = tried, mid
        else:
            low = mid + 1
    return best


def groups(docs: DataFrame) -> DataFrame:
    """(key, size, rows) per group of equal texts; a row's size is its UTF-8 bytes plus 1."""
    return docs.groupBy(text_key().alias("key")).agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"), F.count("*").alias("rows")
    )


def pack(grouped: DataFrame, parts: int = PACK) -> DataFrame:
    """``grouped`` with ``pack``, unique over all tasks; a pack holds about a ``parts``-th of all bytes, or one larger group."""
    total = grouped.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    capacity = max(1, total // parts)

    def run(frames):
        open_bins, n, task = OpenBins(), 0, TaskContext.get().partitionId()
        for frame in frames:
            numbers = []
            for size in frame["size"].tolist():
                found = open_bins.take_tightest(size)
                room, number = found if found else (max(capacity, size), n)
                n += found is None
                numbers.append(number)
                if room > size:
                    open_bins.add(room - size, number)
            yield frame.assign(pack=[f"{task}:{x}" for x in numbers])

    descending = grouped.repartition("key").sortWithinPartitions(F.desc("size"), "key")
    return stage(descending.mapInPandas(run, "key binary, size long, rows long, pack string"), "packs")


def assign(docs: DataFrame, shards: int | None = None, capacity: int | None = None, parts: int = PACK) -> DataFrame:
    """(key, shard) of every group: ``shards`` near-equal shards, or as few as hold ``capacity`` bytes each."""
    packs = pack(stage(groups(docs), "groups"), parts)
    # Some thousands of rows whatever the data: PACK full packs, as many open ones, one per task.
    sizes = packs.groupBy("pack").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "pack").toPandas()
    ordered = sizes["size"].astype(int).tolist()
    places = best_fit(ordered, capacity) if capacity else least_capacity(ordered, shards)
    table = pd.DataFrame({"pack": sizes["pack"].astype(str), "shard": pd.Series(places, dtype="int32")})
    spark = docs.sparkSession
    of = spark.createDataFrame(table, "pack string, shard int")
    return stage(packs.join(F.broadcast(of), "pack").select("key", "shard"), "shards")


def place(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0 without gaps in each shard, by doc_id) of every row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        text_key().alias("key"),
    )
    return number_rows(
        rows.join(assign(docs, shards), "key").drop("key"), [F.col("doc_id"), F.col("text_crc32")], "slot", ["shard"], 0
    )
