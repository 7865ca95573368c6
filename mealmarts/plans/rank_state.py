"""Dish rankings kept up to date by a day's ratings.

Stored are mergeable sums per user and dish and the two lists of every user, both in partitions by a hash of
the user. A day is reduced to sums per user and dish; only the partitions of its users are read, its sums added and the
lists of its users made anew. The large tables are not rewritten for that: users that changed have all their rows, sums
and lists, in two small tables beside them (``RECENT``), which hold instead of those in the large ones. Where a small
partition has grown to a share of the large one (``FOLD``), it is folded into it and dropped. A run that breaks off
there leaves equal rows in both.

Every partition says up to which day it is. A day that a partition has seen already (sent twice, repeated after a
broken run, corrected, or late behind a newer day) is not added: the sums of its users are counted again from the
facts there. So the lists always equal those of all facts. Sums of half points are exact in any order.

Ratings come as stored facts do: one per user, dish and day, no null ids.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mealmarts.operators.loads import drop_parts, read_table, replace_parts, stored_parts
from mealmarts.plans.user_marts import RANK_DEPTH, best_and_worst
from mealmarts.session import stage

SUMS, LISTS = "user_food_state", "user_rank_state"
RECENT = {SUMS: "user_food_recent", LISTS: "user_rank_recent"}
FOLD = 8  # a partition's changed rows are folded in when they are more than an eighth of its rows
BUCKETS = 64  # part of the tables' layout: not to be changed once they exist


def _bucket() -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).cast("int").alias("bucket")


def _sums(ratings: DataFrame) -> DataFrame:
    sums = ratings.groupBy("user_id", "food_id").agg(F.sum("food_score").alias("total"), F.count("food_score").alias("n"))
    return sums.select(_bucket(), "user_id", "food_id", "total", "n")


def _lists(sums: DataFrame, depth: int) -> DataFrame:
    means = sums.select("bucket", "user_id", "food_id", F.try_divide("total", "n").alias("food_score"))
    return best_and_worst(means, depth)


def start_ranks(ratings: DataFrame, root: str, day: str, depth: int = RANK_DEPTH) -> None:
    """Build both tables from all ratings up to ``day``.

    The lists follow from the stored sums: there a user's rows lie in a file or two, so a task cuts them to ``depth``
    before the shuffle.
    """
    spark = ratings.sparkSession
    replace_parts(_sums(ratings).withColumn("as_of", F.lit(day).cast("date")), root, SUMS)
    replace_parts(_lists(read_table(spark, root, SUMS), depth), root, LISTS)
    for recent in RECENT.values():
        drop_parts(spark, root, recent, stored_parts(spark, root, recent))


def touched_parts(spark: SparkSession, root: str, table: str, buckets: list[int]) -> DataFrame:
    """The stored rows of some partitions, which reach the scan as literals."""
    return read_table(spark, root, table).filter(F.col("bucket").isin(buckets))


def _newest(stored: DataFrame) -> dict[int, dt.date]:
    return {r.bucket: r.as_of for r in stored.groupBy("bucket").agg(F.max("as_of").alias("as_of")).collect()}


def add_day(ratings: DataFrame, root: str, day: str, history: DataFrame, depth: int = RANK_DEPTH) -> None:
    """Take in one day's ratings. ``history``: all facts, this day's included, read only for days seen before."""
    spark, names = ratings.sparkSession, ["bucket", "user_id", "food_id", "total", "n"]
    delta = stage(_sums(ratings), "day-sums")
    buckets = [r.bucket for r in delta.select("bucket").distinct().collect()]  # at most BUCKETS numbers
    if not buckets:
        return
    stored, recent = (touched_parts(spark, root, table, buckets) for table in (SUMS, RECENT[SUMS]))
    seen = _newest(recent)  # never behind the large table
    seen |= _newest(stored.filter(~F.col("bucket").isin([*seen])))
    again = [b for b, as_of in seen.items() if as_of.isoformat() >= day]
    users = delta.select("user_id").distinct()
    unchanged = users.join(recent.join(users, "user_id", "left_semi"), "user_id", "left_anti")
    is_again = F.col("bucket").isin(again)
    added = (
        stored.join(unchanged, "user_id", "left_semi")
        .select(*names)
        .unionByName(recent.select(*names))
        .unionByName(delta)
        .filter(~is_again)
        .groupBy("bucket", "user_id", "food_id")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .withColumn("as_of", F.lit(day).cast("date"))
    )
    if again:
        recounted = _sums(history.join(users, "user_id", "left_semi")).filter(is_again)
        others = recent.filter(is_again).join(users, "user_id", "left_anti").select(*names)
        as_of = F.create_map(*[x for b in again for x in (F.lit(b), F.lit(seen[b]))])
        added = added.unionByName(others.unionByName(recounted).withColumn("as_of", as_of[F.col("bucket")]))
    sums = stage(added, "sums")
    fresh = _lists(sums.join(users, "user_id", "left_semi"), depth)
    kept = touched_parts(spark, root, RECENT[LISTS], buckets).join(users, "user_id", "left_anti")
    lists = stage(kept.unionByName(fresh.select(*kept.columns)), "lists")
    replace_parts(sums, root, RECENT[SUMS])
    replace_parts(lists, root, RECENT[LISTS])
    changed, rows = ({r.bucket: r["count"] for r in t.groupBy("bucket").count().collect()} for t in (sums, stored))
    full = [b for b, n in changed.items() if n * FOLD > rows.get(b, 0)]
    if full:
        fold(spark, root, full)


def _current(stored: DataFrame, recent: DataFrame) -> DataFrame:
    """Every user's rows: the changed ones where there are any."""
    others = stored.join(recent.select("user_id").distinct(), "user_id", "left_anti")
    return others.select(*recent.columns).unionByName(recent)


def fold(spark: SparkSession, root: str, buckets: list[int]) -> None:
    """Put the changed users' rows of some partitions in place of those in the large tables."""
    for table, recent in RECENT.items():
        rows = _current(*(touched_parts(spark, root, name, buckets) for name in (table, recent)))
        replace_parts(stage(rows, table), root, table)
    for recent in RECENT.values():
        drop_parts(spark, root, recent, buckets)


def stored_ranks(spark: SparkSession, root: str, attributes: DataFrame) -> DataFrame:
    """The mart: dishes take their names here, so a new name needs no run."""
    lists = _current(read_table(spark, root, LISTS), read_table(spark, root, RECENT[LISTS]))
    ranked = lists.join(attributes.select("food_id", "food_name"), "food_id", "left")
    return ranked.select("user_id", "food_name", "food_score", "rank_order", "score_type")
