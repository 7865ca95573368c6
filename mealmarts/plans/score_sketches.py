"""Quartiles of any stretch of days from stored daily sketches.

A day's scores become one KLL sketch of ``K``. Sketches of days merge to months or any other stretch, so quartiles
read a row per day in place of all scores. The rank of a quartile is right within ``RANK_ERROR`` of the
number of scores. Null scores are in no sketch; a day with nothing else has no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.functions.columns import month_text
from mealmarts.operators.loads import read_table, store

TABLE = "score_sketch_day"
K = 800
RANK_ERROR = 0.0133  # what a sketch of 200 promises; one of 800 stays far below


def daily_sketches(food_review: DataFrame) -> DataFrame:
    """(start, day, sketch): one row per day with a score; combined in each task before the shuffle."""
    days = food_review.filter("food_score is not null and timestamp is not null").groupBy(F.to_date("timestamp").alias("day"))
    sketches = days.agg(F.kll_sketch_agg_double(F.col("food_score").cast("double"), F.lit(K)).alias("sketch"))
    return sketches.select(F.trunc("day", "MM").alias("start"), "day", "sketch")


def store_sketches(food_review: DataFrame, root: str) -> None:
    """Sketches of the given days replace those stored for the same days; only their months are read and rewritten."""
    store(daily_sketches(food_review), root, TABLE, "overwrite")


def merged_quartiles(sketches: DataFrame) -> DataFrame:
    """(month, n, q1, q3) from daily sketches."""
    months = sketches.groupBy("start").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return months.select(
        month_text("start").alias("month"),
        F.kll_sketch_get_n_double("sketch").alias("n"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in (("q1", 0.25), ("q3", 0.75))],
    )


def stored_quartiles(spark, root: str) -> DataFrame:
    return merged_quartiles(read_table(spark, root, TABLE))


def within_error(quartiles: DataFrame, food_review: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """(month, n, q1_within, q3_within): whether the exact rank of each quartile is within the error.

    A score's rank is every share from that of lower scores to that of scores up to it. Quartiles are a row per month.
    """
    scores = food_review.select(month_text("timestamp").alias("month"), F.col("food_score").alias("score")).filter("score is not null")
    joined = scores.join(quartiles, "month")
    checks = []
    for name, q in (("q1", 0.25), ("q3", 0.75)):
        low, high = F.count_if(F.col("score") < F.col(name)), F.count_if(F.col("score") <= F.col(name))
        total = F.count("*")
        checks.append(((low / total - error <= q) & (high / total + error >= q)).alias(f"{name}_within"))
    return joined.groupBy("month").agg(F.min("n").alias("n"), *checks)
