"""Star schema: two dimensions and two daily facts out of the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.functions.columns import in_day, leading_int
from mealmarts.operators.ranking import greatest_row, one_per_key
from mealmarts.session import stage


def dim_user(account: DataFrame) -> DataFrame:
    """One row per user; of repeated accounts the first in column order wins."""
    users = account.select(
        "user_id",
        F.lower("gender").alias("gender"),
        F.year("birth_date").alias("birth_year"),
        leading_int("ssafy_year").alias("ssafy_year"),
        leading_int("class_num").alias("ssafy_class"),
        "ssafy_region",
    )
    return one_per_key(users, ["user_id"], [F.col(c).asc_nulls_first() for c in users.columns[1:]])


def _main_sub_code(label: str):
    # Labels of the source and their codes.
    return (
        F.when(F.col(label) == "주메뉴", "main")
        .when(F.col(label) == "서브메뉴", "sub")
        .otherwise("etc")
    )


def dim_menu_food(menu_food: DataFrame, food: DataFrame, menu: DataFrame) -> DataFrame:
    """One row per dish on a menu, with the attributes of the dish."""
    dishes = food.select(
        "food_id",
        "food_name",
        _main_sub_code("main_sub").alias("main_sub"),
        F.col("category").alias("category_name"),
        F.col("tag").alias("tag_name"),
    )
    days = menu.select("menu_id", F.col("date").alias("menu_date"))
    # Links are made unique before the joins: (menu, food) is the key of the result.
    links = menu_food.select("menu_id", "food_id").distinct()
    return (
        links.join(dishes, "food_id")
        .join(days, "menu_id")
        .select("menu_id", "menu_date", "food_id", "food_name", "main_sub", "category_name", "tag_name")
    )


def food_attributes(dim_menu_food: DataFrame) -> DataFrame:
    """One row per dish, staged for joins with the ratings, where one dish may be hot.

    Attributes hang on the dish alone, so ``min`` picks the value. ``menus`` counts its menus.
    """
    attributes = dim_menu_food.groupBy("food_id").agg(
        *[F.min(c).alias(c) for c in ("food_name", "category_name", "tag_name")], F.count("*").alias("menus")
    )
    return stage(attributes, "food-attributes")


def food_feedback(food_review: DataFrame, day: str | None = None) -> DataFrame:
    """Dish ratings of a day (``None``: all days); the highest source id wins on a repeat."""
    rows = in_day(food_review, "timestamp", day).select(
        "id", "user_id", "food_id", "food_score", F.to_date("timestamp").alias("rating_date")
    )
    newest = greatest_row(rows, ["user_id", "food_id", "rating_date"], ["id", "food_score"])
    return newest.select("user_id", "food_id", "food_score", "rating_date")


def menu_feedback(menu_review: DataFrame, pre_vote: DataFrame, day: str | None = None) -> DataFrame:
    """Menu reviews of a day with a flag for an advance vote of the same user and menu."""
    rows = in_day(menu_review, "timestamp", day).select(
        "id", "user_id", "menu_id", "menu_score", "menu_regret", "menu_comment",
        F.to_date("timestamp").alias("comment_date"),
    )
    reviews = greatest_row(
        rows, ["user_id", "menu_id", "comment_date"], ["id", "menu_score", "menu_regret", "menu_comment"]
    )
    # Distinct votes: a repeated vote must not repeat the review.
    votes = pre_vote.select("user_id", "menu_id").distinct().withColumn("voted", F.lit(1))
    return reviews.join(votes, ["user_id", "menu_id"], "left").select(
        "user_id", "menu_id", "menu_score", "menu_regret", "menu_comment",
        F.coalesce("voted", F.lit(0)).alias("pre_vote"),
        "comment_date",
    )


def rated_users(food_feedback: DataFrame) -> DataFrame:
    return food_feedback.select("user_id").distinct()
