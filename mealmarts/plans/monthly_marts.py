"""Monthly reports. ``month=None`` builds every month in one pass, ``"YYYY-MM"`` one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mealmarts.functions.columns import decimal_score, in_month, month_text, previous_month
from mealmarts.operators.ranking import number_rows, top_n

# Rows kept per ranking; stands in for a date that is missing.
RANK_DEPTH = 5
NO_DATE = "1900-01-01"


def monthly_food_ranking(
    food_review: DataFrame, food: DataFrame, month: str | None = None, depth: int = RANK_DEPTH
) -> DataFrame:
    """Best and worst dishes of a month by unrounded mean; ties go to the lower food id.

    Ratings are reduced to one row per dish and month, and those to ten per month, before names are joined.
    """
    means = (
        in_month(food_review, "timestamp", month)
        .groupBy(month_text("timestamp").alias("month"), "food_id")
        .agg(F.avg("food_score").alias("mean"), F.count("*").alias("count"))
    )
    known = means.join(food.select("food_id"), "food_id", "left_semi")
    best = top_n(known, ["month"], [F.col("mean").desc_nulls_last(), F.col("food_id")], depth, "rank")
    worst = top_n(known, ["month"], [F.col("mean").asc_nulls_first(), F.col("food_id")], depth, "rank")
    ranked = best.withColumn("rank_type", F.lit("best")).unionByName(worst.withColumn("rank_type", F.lit("worst")))
    return ranked.join(food.select("food_id", "food_name"), "food_id").select(
        "month", "food_id", "food_name", decimal_score(F.col("mean")).alias("avg_score"), "rank_type", "rank", "count"
    )


def _monthly_votes(pre_vote: DataFrame, menu: DataFrame, month: str | None, *keys: str) -> DataFrame:
    """Advance votes counted per menu (and user) first, then dated by their menu."""
    votes = pre_vote.groupBy("menu_id", *keys).agg(F.count("*").alias("votes"))
    return votes.join(in_month(menu, "date", month).select("menu_id", "date"), "menu_id")


def _evaluations(menu_review: DataFrame, pre_vote: DataFrame, menu: DataFrame, month: str | None) -> DataFrame:
    reviews = (
        in_month(menu_review, "timestamp", month)
        .groupBy(month_text("timestamp").alias("month"))
        .agg(F.count("*").alias("n"))
    )
    votes = (
        _monthly_votes(pre_vote, menu, month)
        .groupBy(month_text("date").alias("month"))
        .agg(F.sum("votes").alias("n"))
    )
    return reviews.unionByName(votes)


def monthly_count(menu_review: DataFrame, pre_vote: DataFrame, menu: DataFrame, month: str) -> DataFrame:
    """Reviews and advance votes of one month, as a first report: all three numbers agree."""
    total = _evaluations(menu_review, pre_vote, menu, month).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return total.select(*[F.col("n").alias(c) for c in ("evaluator", "cumulative", "difference")])


def monthly_count_series(menu_review: DataFrame, pre_vote: DataFrame, menu: DataFrame) -> DataFrame:
    """All months with running total and change against the month before in the table.

    The windows run over one row per month, after the counts are complete.
    """
    by_month = Window.orderBy("month")
    months = _evaluations(menu_review, pre_vote, menu, None).groupBy("month").agg(F.sum("n").alias("evaluator"))
    return months.select(
        "month",
        "evaluator",
        F.sum("evaluator").over(by_month).alias("cumulative"),
        (F.col("evaluator") - F.lag("evaluator", 1, 0).over(by_month)).alias("difference"),
    )


def cumulative_distinct_evaluators(menu_review: DataFrame, pre_vote: DataFrame) -> DataFrame:
    """Users who ever reviewed a menu or voted for one."""
    people = menu_review.select("user_id").union(pre_vote.select("user_id")).distinct()
    return people.agg(F.count("*").alias("cumulative_evaluators"))


def running_distinct_evaluators(menu_review: DataFrame, pre_vote: DataFrame, menu: DataFrame) -> DataFrame:
    """Per month with evaluations: users seen for the first time, and users ever seen up to then.

    A user shrinks to the first month over both sources and the months of activity, in one shuffle on the user; a
    prefix sum over one row per month follows, so no month recounts the ones before it. Without a user or a month a
    row counts for nobody, but its month is there.
    """
    reviews = menu_review.select("user_id", month_text("timestamp").alias("month"))
    votes = _monthly_votes(pre_vote, menu, None, "user_id").select("user_id", month_text("date").alias("month"))
    people = (
        reviews.unionByName(votes)
        .filter(F.col("month").isNotNull())
        .groupBy("user_id")
        .agg(F.min("month").alias("first"), F.collect_set("month").alias("months"))  # at most one entry per month of the calendar
    )
    is_new = F.col("user_id").isNotNull() & (F.col("month") == F.col("first"))
    months = (
        people.select("user_id", "first", F.explode("months").alias("month"))
        .groupBy("month")
        .agg(F.count_if(is_new).alias("new_evaluators"))
    )
    return months.withColumn("cumulative_evaluators", F.sum("new_evaluators").over(Window.orderBy("month")))


def _statistics(score: Column) -> list[Column]:
    def two_digits(value):
        return decimal_score(F.round(value, 2))

    return [
        F.min(score).cast("int").alias("min"),
        F.max(score).cast("int").alias("max"),
        two_digits(F.avg(score)).alias("avg"),
        F.percentile_approx(score, 0.25).cast("int").alias("q1"),
        F.percentile_approx(score, 0.75).cast("int").alias("q3"),
        two_digits(F.var_samp(score)).alias("variance"),
        two_digits(F.stddev_samp(score)).alias("stdev"),
    ]


def monthly_statistic(food_review: DataFrame, month: str | None = None) -> DataFrame:
    """Spread of the scores; one month without ratings still gives its row."""
    rows, columns = in_month(food_review, "timestamp", month), _statistics(F.col("food_score"))
    if month is None:
        return rows.groupBy(month_text("timestamp").alias("month")).agg(*columns)
    return rows.agg(*columns).select(F.lit(month).alias("month"), "*")


def monthly_frequent_evaluator(
    food_review: DataFrame, pre_vote: DataFrame, menu: DataFrame, account: DataFrame, month: str | None = None
) -> DataFrame:
    """All users of a month ranked by dish ratings plus advance votes; ties by name, then id.

    Both sides leave their aggregates partitioned as the outer join needs them.
    """
    keys = ["month", "user_id"]
    ratings = (
        in_month(food_review, "timestamp", month)
        .groupBy(month_text("timestamp").alias("month"), "user_id")
        .agg(F.count("*").alias("ratings"), F.max("timestamp").alias("last_rating"))
    )
    votes = (
        _monthly_votes(pre_vote, menu, month, "user_id")
        .groupBy(month_text("date").alias("month"), "user_id")
        .agg(F.sum("votes").alias("votes"), F.max("date").alias("last_vote"))
    )
    moment = ratings.schema["last_rating"].dataType

    def or_never(column):
        return F.coalesce(F.col(column).cast(moment), F.lit(NO_DATE).cast(moment))

    activity = ratings.join(votes, keys, "full_outer").fillna(0, ["ratings", "votes"])
    named = activity.join(account.select("user_id", F.col("username").alias("name")), "user_id").select(
        *keys,
        "name",
        (F.col("ratings") + F.col("votes")).alias("evaluates"),
        F.greatest(or_never("last_rating"), or_never("last_vote")).alias("last_evaluate"),
    )
    order = [F.col("evaluates").desc(), F.col("name").asc_nulls_first(), F.col("user_id").asc()]
    ranked = number_rows(named, order, "rank", ["month"])
    return ranked.select("month", "rank", "name", "evaluates", "last_evaluate")


def class_engagement_monthly(menu_review: DataFrame, account: DataFrame, month: str | None = None) -> DataFrame:
    """Menu reviews per month, class and generation; counted per user before users are joined."""
    counts = (
        in_month(menu_review, "timestamp", month)
        .groupBy(F.trunc("timestamp", "MM").alias("month"), "user_id")
        .agg(F.count("*").alias("n"))
    )
    classes = account.select("user_id", F.col("class_num").alias("class"), F.col("ssafy_year").alias("generation"))
    return counts.join(classes, "user_id").groupBy("month", "class", "generation").agg(F.sum("n").alias("review_count"))


def report_months(menu_review: DataFrame) -> DataFrame:
    """Months with reviews and, for each, the month its scheduled run reports on."""
    months = menu_review.groupBy(F.trunc("timestamp", "MM").alias("start")).agg(F.count("*").alias("review_count"))
    return months.select(
        month_text("start").alias("month"), previous_month("start").alias("previous_month"), "review_count"
    )
