"""Daily marts: one or a few rows per user over the whole rating history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.functions.columns import age_band, mean_from
from mealmarts.operators.ranking import one_per_key, top_n
from mealmarts.schemas import GROUP_TYPES
from mealmarts.session import stage

# Rows kept per user and list; year that ages count from.
RANK_DEPTH = 5
AS_OF_YEAR = 2025


def user_summary(ratings: DataFrame, menu_feedback: DataFrame) -> DataFrame:
    """Mean score, ratings with a score and advance votes of every user who rated a dish."""
    scores = ratings.groupBy("user_id").agg(
        F.avg("food_score").alias("avg_score"), F.count("food_score").alias("total_reviews")
    )
    votes = menu_feedback.groupBy("user_id").agg(F.sum("pre_vote").alias("pre_vote_count"))
    return scores.join(votes, "user_id", "left").fillna(0)


def best_and_worst(means: DataFrame, depth: int = RANK_DEPTH) -> DataFrame:
    """Both lists of every user of ``means`` (user_id, food_id, food_score); ties go to the lower food id."""
    score, tie = F.col("food_score"), F.col("food_id")
    best = top_n(means, ["user_id"], [score.desc_nulls_last(), tie], depth, "rank_order")
    worst = top_n(means, ["user_id"], [score.asc_nulls_first(), tie], depth, "rank_order")
    return best.withColumn("score_type", F.lit("best")).unionByName(worst.withColumn("score_type", F.lit("worst")))


def user_food_rating_rank(ratings: DataFrame, attributes: DataFrame, depth: int = RANK_DEPTH) -> DataFrame:
    """Best and worst dishes per user by mean score; ties go to the lower food id.

    Both lists are cut before names are joined. They read the same shuffle of means.
    """
    means = ratings.groupBy("user_id", "food_id").agg(F.avg("food_score").alias("food_score"))
    ranked = best_and_worst(means, depth)
    return ranked.join(attributes.select("food_id", "food_name"), "food_id", "left").select(
        "user_id", "food_name", "food_score", "rank_order", "score_type"
    )


def best_foods(ratings: DataFrame, attributes: DataFrame, depth: int) -> DataFrame:
    """The best dishes of ``user_food_rating_rank`` alone."""
    means = ratings.groupBy("user_id", "food_id").agg(F.avg("food_score").alias("food_score"))
    best = top_n(means, ["user_id"], [F.col("food_score").desc_nulls_last(), F.col("food_id")], depth, "rank_order")
    named = best.join(attributes.select("food_id", "food_name"), "food_id", "left")
    return named.select("user_id", "food_name", "food_score", "rank_order", F.lit("best").alias("score_type"))


def _rating_counts(ratings: DataFrame, attributes: DataFrame, attribute: str, name: str) -> DataFrame:
    return (
        ratings.join(attributes.select("food_id", F.col(attribute).alias(name)), "food_id")
        .groupBy("user_id", name)
        .agg(F.count("*").alias("count"))
    )


def user_category_stats(ratings: DataFrame, attributes: DataFrame) -> DataFrame:
    return _rating_counts(ratings, attributes, "category_name", "category")


def user_tag_stats(ratings: DataFrame, attributes: DataFrame) -> DataFrame:
    return _rating_counts(ratings, attributes, "tag_name", "tag")


def _category_totals(ratings: DataFrame, attributes: DataFrame, users: DataFrame, as_of_year: int) -> DataFrame:
    """Score sums per user and category with the user's groups. Every gender code that occurs is a group.

    Users join after this aggregate, so a user with very many ratings brings only as many
    rows to that join as there are categories.
    """
    totals = (
        ratings.join(attributes.select("food_id", "category_name"), "food_id")
        .groupBy("user_id", "category_name")
        .agg(F.sum("food_score").alias("total"), F.count("food_score").alias("n"))
    )
    groups = users.select("user_id", "gender", age_band("birth_year", as_of_year).alias("age_group"))
    return totals.join(groups, "user_id")


def _group_rows(totals: DataFrame) -> DataFrame:
    # First down to gender x age x category, so the grouping sets expand a handful of rows.
    cells = totals.groupBy("gender", "age_group", "category_name").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    sets = cells.groupingSets([[], ["gender"], ["age_group"]], "gender", "age_group").agg(
        F.grouping_id().alias("level"),
        mean_from(F.col("total"), F.col("n")).alias("group_avg_score"),
        F.count_distinct("category_name").alias("group_diversity_score"),
    )
    by_all, by_gender, by_age = (F.lit(g) for g in GROUP_TYPES)
    # grouping_id has a bit per column that is summed over: 3 = both, 1 = age only, 2 = gender only.
    return sets.select(
        F.when(F.col("level") == 3, by_all).when(F.col("level") == 1, by_gender).otherwise(by_age).alias("group_type"),
        F.when(F.col("level") == 3, by_all)
        .when(F.col("level") == 1, F.col("gender"))
        .otherwise(F.col("age_group").cast("string"))
        .alias("group_value"),
        "group_avg_score",
        "group_diversity_score",
    )


def group_stats(
    ratings: DataFrame, attributes: DataFrame, users: DataFrame, as_of_year: int = AS_OF_YEAR
) -> DataFrame:
    """Mean over ratings and number of categories: everyone, per gender, per age band."""
    return _group_rows(_category_totals(ratings, attributes, users, as_of_year))


def user_group_comparison(
    ratings: DataFrame, attributes: DataFrame, users: DataFrame, as_of_year: int = AS_OF_YEAR
) -> DataFrame:
    """Each user's mean and number of categories beside those of the groups they belong to.

    The totals, a row per user and category, are staged: both sides follow from them without reading the ratings again.
    """
    totals = stage(_category_totals(ratings, attributes, users, as_of_year), "category-totals")
    own = totals.groupBy("user_id", "gender", "age_group").agg(
        mean_from(F.col("total"), F.col("n")).alias("user_avg_score"),
        # A user has one row per category here, so counting rows counts categories.
        F.count("category_name").alias("user_diversity_score"),
    )
    everyone, gender, age = GROUP_TYPES
    memberships = F.array(
        *[
            F.struct(F.lit(kind).alias("group_type"), value.alias("group_value"))
            for kind, value in (
                (everyone, F.lit(everyone)),
                (gender, F.col("gender")),
                (age, F.col("age_group").cast("string")),
            )
        ]
    )
    members = own.withColumn("g", F.explode(memberships)).select(
        "user_id", "g.group_type", "g.group_value", "user_avg_score", "user_diversity_score"
    )
    # Staged: every user matches the row for everyone. The planner sees how small this side is and
    # sends it to the users; were it large, the one hot key would be split.
    groups = stage(_group_rows(totals), "groups")
    return members.join(groups, ["group_type", "group_value"]).select(
        "user_id", "group_type", "group_value",
        "user_avg_score", "group_avg_score", "user_diversity_score", "group_diversity_score",
    )


def recent_reviews(menu_review: DataFrame, days: int) -> DataFrame:
    """Per user: reviews from ``days`` days before the user's newest one on, and that moment."""
    newest = stage(menu_review.groupBy("user_id").agg(F.max("timestamp").alias("newest")), "newest")
    since = F.col("newest") - F.make_dt_interval(F.lit(days))
    recent = menu_review.select("user_id", "timestamp").join(newest.select("user_id", since.alias("since")), "user_id")
    return recent.filter(F.col("timestamp") >= F.col("since")).groupBy("user_id", "since").agg(F.count("*").alias("review_count"))


def user_review_word(review_words: DataFrame) -> DataFrame:
    """Uses of a word by a user over all days."""
    return review_words.groupBy("user_id", "word").agg(F.sum("count").alias("count"))


def user_insight_latest(insights: DataFrame, tie: str | None = None) -> DataFrame:
    """Newest insight per user; ``tie`` orders several of one day, highest first."""
    order = [F.col("insight_date").desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in (tie or "insight",)]
    return one_per_key(insights, ["user_id"], order).select("user_id", "insight")
