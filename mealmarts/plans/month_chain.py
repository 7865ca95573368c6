"""Monthly count as a chain: a stored row per month, extended month by month.

A run reads its own month's evaluations and the stored row before it. Late rows of an earlier month are
taken in by running that month again: its count is made anew, and the totals of the months after it follow from their
stored counts, whose evaluations are not read. The table has a partition per month, and a run rewrites
those from its month on, so it can be repeated.

A month without evaluations has no row, unless it had one before: then it stays with 0. Evaluations
without a date belong to no month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mealmarts.functions.columns import month_bounds, month_text
from mealmarts.operators.loads import read_table, replace_parts, stored_parts
from mealmarts.plans.monthly_marts import monthly_count, monthly_count_series
from mealmarts.session import stage

TABLE = "monthly_count_state"


def _start(month: str) -> str:
    return month_bounds(month)[0].isoformat()


def start_chain(menu_review: DataFrame, pre_vote: DataFrame, menu: DataFrame, root: str, before: str) -> None:
    """Store all months before ``before`` (YYYY-MM) in one pass."""
    months = monthly_count_series(menu_review, pre_vote, menu).withColumn("start", F.to_date(F.concat("month", F.lit("-01"))))
    replace_parts(stage(months.filter(F.col("start") < F.lit(_start(before)).cast("date")), "months"), root, TABLE)


def chain_inputs(menu_review: DataFrame, pre_vote: DataFrame, menu: DataFrame, root: str, month: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a run reads: the month's own count, the stored row before it, and the stored rows after it, each by literal partitions."""
    spark, start = menu_review.sparkSession, _start(month)
    stored, parts = read_table(spark, root, TABLE), stored_parts(spark, root, TABLE)
    day = F.col("start")
    earlier, later = [p for p in parts if p < start], [p for p in parts if p > start]

    def rows(names: list[str]) -> DataFrame:
        return stored.filter(day.isin([F.lit(n).cast("date") for n in names])) if names else stored.limit(0)

    own = monthly_count(menu_review, pre_vote, menu, month).select(F.lit(start).cast("date").alias("start"), "evaluator")
    return own if start in parts else own.filter("evaluator > 0"), rows(earlier[-1:]), rows(later)


def extend_chain(menu_review: DataFrame, pre_vote: DataFrame, menu: DataFrame, root: str, month: str) -> None:
    """Add a month, or count it anew, and carry its totals through the months after it."""
    own, before, later = chain_inputs(menu_review, pre_vote, menu, root, month)
    fresh = own.unionByName(later.select("start", "evaluator")).withColumn("total", F.col("evaluator"))
    chain = before.select("start", "evaluator", F.col("cumulative").alias("total")).unionByName(fresh)
    by_month = Window.orderBy("start")  # the stored row before, and a row per month from here on
    rows = chain.select(
        "start",
        "evaluator",
        F.sum("total").over(by_month).alias("cumulative"),
        (F.col("evaluator") - F.lag("evaluator", 1, 0).over(by_month)).alias("difference"),
    )
    replace_parts(stage(rows.filter(F.col("start") >= F.lit(_start(month)).cast("date")), "chain"), root, TABLE)


def stored_months(spark, root: str) -> DataFrame:
    """The report: month, evaluator, cumulative, difference."""
    rows = read_table(spark, root, TABLE)
    return rows.select(month_text("start").alias("month"), "evaluator", "cumulative", "difference")
