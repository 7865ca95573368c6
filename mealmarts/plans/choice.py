"""Which of the day's two menus will a user take: training rows for menu A against menu B.

All jobs work on every date at once; a single date is a filter on the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mealmarts.functions.columns import in_day
from mealmarts.operators.ranking import number_rows
from mealmarts.plans.user_marts import AS_OF_YEAR
from mealmarts.schemas import contract
from mealmarts.session import stage

SIDES = ("A", "B")


def menu_counts(menu: DataFrame) -> DataFrame:
    """Number of menus per date."""
    return menu.groupBy("date").agg(F.count_distinct("menu_id").alias("menu_count"))


def ab_gate(menu: DataFrame) -> DataFrame:
    """Dates that offer a choice."""
    return menu_counts(menu).filter("menu_count >= 2")


def menu_pairs(menu: DataFrame, day: str | None = None) -> DataFrame:
    """Menu A (lowest id) and menu B (highest id) of every date with two menus or more, or of one date."""
    return (
        in_day(menu, "date", day)
        .groupBy("date")
        .agg(F.min("menu_id").alias("menu_id_a"), F.max("menu_id").alias("menu_id_b"))
        .filter("menu_id_a < menu_id_b")
    )


def dish_menus(dim_menu_food: DataFrame) -> DataFrame:
    """Menus that have dishes, in the columns ``menu_pairs`` reads."""
    return dim_menu_food.select("menu_id", F.col("menu_date").alias("date"))


# --- comparison of the two menus per review --------------------------------------------


def food_features(food: DataFrame, food_review: DataFrame) -> DataFrame:
    """Attributes of every dish with its mean score and reviews; null without reviews."""
    stats = food_review.groupBy("food_id").agg(
        F.avg("food_score").alias("avg_food_score"), F.count("id").alias("review_count")
    )
    return food.select("food_id", "category", "tag", "main_sub").join(stats, "food_id", "left")


def menu_dishes(menu_food: DataFrame, features: DataFrame) -> DataFrame:
    """Dishes of every menu with their figures, a row each: what the comparison's menus consist of."""
    return menu_food.select("menu_id", "food_id").join(features, "food_id")


def menu_features(menu_food: DataFrame, features: DataFrame) -> DataFrame:
    """Dishes of a menu, mean of their means, dishes with reviews, and reviews.

    The list of dishes is part of the result; (menu, dish) is a key, so a menu holds each once. A menu is
    small by contract, as is the list; it stays here, once per menu.
    """
    return (
        menu_food.join(features.select("food_id", "avg_food_score", "review_count"), "food_id")
        .groupBy("menu_id")
        .agg(
            F.array_sort(F.collect_list("food_id")).alias("food_ids"),
            F.avg("avg_food_score").alias("avg_food_score"),
            F.count("review_count").alias("review_count"),
            F.sum("review_count").alias("total_reviews"),
        )
    )


def _side(features: DataFrame, side: str) -> DataFrame:
    return features.select(
        F.col("menu_id").alias(f"menu_id_{side}"),
        *[F.col(c).alias(f"{c}_{side}") for c in ("avg_food_score", "review_count")],
    )


def menu_comparison(
    menu_review: DataFrame,
    menu: DataFrame,
    account: DataFrame,
    features: DataFrame,
    day: str | None = None,
    as_of_year: int = AS_OF_YEAR,
) -> DataFrame:
    """Per review on a date with two menus: both menus' figures, the user's, and the choice.

    Menu features join the pairs first, one row per date, and only then the reviews. Both menus' ids are
    here; their dishes are in ``menu_dishes``, as a list per review would grow with the square of the data.
    """
    offers = menu_pairs(menu, day)
    for side in ("a", "b"):
        offers = offers.join(_side(features, side), f"menu_id_{side}")
    choices = in_day(menu_review, "timestamp", day).select(
        F.col("id").alias("review_id"),
        "user_id",
        F.col("menu_id").alias("chosen_menu_id"),
        F.to_date("timestamp").alias("date"),
    )
    people = account.select(
        "user_id",
        "gender",
        (F.lit(as_of_year) - F.year("birth_date")).alias("age"),
        F.col("ssafy_region").alias("region"),
        "class_num",
    )
    return (
        choices.join(offers, "date")
        .join(people, "user_id")
        .select(
            "review_id", "user_id", "date", "menu_id_a", "menu_id_b", "chosen_menu_id",
            F.when(F.col("chosen_menu_id") == F.col("menu_id_a"), 0).otherwise(1).alias("label"),
            "gender", "age", "region", "class_num",
            *[f"{c}_{s}" for s in ("a", "b") for c in ("avg_food_score", "review_count")],
        )
    )


# --- overlap and affinity features -------------------------------------------------------


def with_codes(dim_menu_food: DataFrame) -> DataFrame:
    """Dishes with numbers in place of the names of their tags and categories, ascending as the names do; null stays null.

    Every row and every user carries such values along and compares them. Numbers are small there, and aggregates
    of them need no sort.
    """
    rows = dim_menu_food.select("menu_id", "menu_date", "food_id", "tag_name", "category_name")
    for column in ("tag_name", "category_name"):
        names = rows.filter(F.col(column).isNotNull()).select(column).distinct()
        codes = stage(number_rows(names, [F.col(column)], "_code"), f"{column}-codes")
        rows = rows.join(codes, column, "left").drop(column).withColumnRenamed("_code", column)
    return rows


def _dish_values(dim_menu_food: DataFrame) -> DataFrame:
    """Tag, category and number of menus of every dish, staged for the join with the ratings, where one dish may be hot."""
    values = dim_menu_food.groupBy("food_id").agg(
        F.min("tag_name").alias("tag"), F.min("category_name").alias("category"), F.count("*").alias("menus")
    )
    return stage(values, "dish-values")


def _liked(ratings: DataFrame, dim_menu_food: DataFrame) -> DataFrame:
    """What users scored at or above their own mean, per tag, category and score.

    A dish counts once for every menu it is on. That number is a weight here, so ratings are
    not multiplied. Scores come in half steps, so after the aggregate a user has a bounded
    number of rows, however many ratings there were, and the window on the user stays small.
    Dishes without a menu count for the user's mean only.
    """
    cells = (
        ratings.filter(F.col("food_score").isNotNull())
        .join(_dish_values(dim_menu_food), "food_id", "left")
        .groupBy("user_id", "tag", "category", "food_score")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("menus"), F.lit(0)).alias("weight"))
    )
    user = Window.partitionBy("user_id")
    own_mean = F.sum(F.col("food_score") * F.col("n")).over(user) / F.sum("n").over(user)
    return cells.withColumn("own_mean", own_mean).filter("food_score >= own_mean AND weight > 0")


def taste_profiles(ratings: DataFrame, dim_menu_food: DataFrame) -> DataFrame:
    """One row per user: maps from liked tags and categories to their weighted mean score.

    Every step after the window keeps its partitioning by user.
    """
    kinds = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("value")) for kind in ("tag", "category")]
    )
    means = (
        _liked(ratings, dim_menu_food)
        .select("user_id", F.explode(kinds).alias("k"), "food_score", "weight")
        .groupBy("user_id", "k.kind", "k.value")
        .agg((F.sum(F.col("food_score") * F.col("weight")) / F.sum("weight")).alias("score"))
    )

    def scores(kind: str) -> Column:
        entry = F.when((F.col("kind") == kind) & F.col("value").isNotNull(), F.struct("value", "score"))
        return F.map_from_entries(F.collect_list(entry)).alias(f"{kind}_scores")

    return means.groupBy("user_id").agg(scores("tag"), scores("category"))


def user_preferences(profiles: DataFrame) -> DataFrame:
    """Liked tags and categories per user, sorted, nulls dropped."""
    return profiles.select(
        "user_id",
        F.array_sort(F.map_keys("tag_scores")).alias("user_tags"),
        F.array_sort(F.map_keys("category_scores")).alias("user_cats"),
    )


def pair_members(pairs: DataFrame) -> DataFrame:
    """One row per menu of a pair: date, side and the class it stands for."""
    return pairs.select(
        F.col("date").alias("train_date"),
        F.explode(
            F.array(
                F.struct(F.col("menu_id_a").alias("menu_id"), F.lit("A").alias("side"), F.lit(0).alias("label")),
                F.struct(F.col("menu_id_b").alias("menu_id"), F.lit("B").alias("side"), F.lit(1).alias("label")),
            )
        ).alias("m"),
    ).select("train_date", "m.menu_id", "m.side", "m.label")


def menu_sets(dim_menu_food: DataFrame, pairs: DataFrame) -> DataFrame:
    """Tags and categories on both menus in ascending order, one row per date.

    Sizes count a missing value as one more value, as it is one of the distinct ones.
    """
    members = pair_members(pairs)
    dishes = dim_menu_food.join(members, "menu_id")
    columns = []
    for side in SIDES:
        here = F.col("side") == side
        for short, source in (("tag", "tag_name"), ("category", "category_name")):
            value = F.when(here, F.col(source))
            columns += [
                F.sort_array(F.collect_set(value)).alias(f"{side}_{short}_set"),
                F.max(F.when(here & F.col(source).isNull(), 1).otherwise(0)).alias(f"{side}_{short}_null"),
            ]
    return dishes.groupBy("train_date").agg(*columns)


def choice_labels(menu_feedback: DataFrame, pairs: DataFrame) -> DataFrame:
    """Scored reviews of a menu of a pair: 0 for A, 1 for B. Both rows stay if a user did both."""
    return (
        menu_feedback.filter(F.col("menu_score").isNotNull())
        .join(pair_members(pairs), "menu_id")
        .select("user_id", "menu_id", "train_date", "label", "menu_regret", "pre_vote")
    )


KINDS = {"tag": "tags", "category": "categories"}


def with_shared_values(rows: DataFrame) -> DataFrame:
    """Values on a menu that the user likes, per side and kind, for all features to read; they keep the menu's order."""
    return rows.withColumns(
        {
            f"{side}_{kind}_shared": F.array_intersect(f"{side}_{kind}_set", F.map_keys(f"{kind}_scores"))
            for kind in KINDS
            for side in SIDES
        }
    )


def overlap_columns() -> list[Column]:
    columns = []
    for kind in KINDS:
        for side in SIDES:
            shared = F.size(f"{side}_{kind}_shared")
            offered = F.size(f"{side}_{kind}_set") + F.col(f"{side}_{kind}_null")
            columns += [
                shared.alias(f"{side}_{kind}_overlap"),
                F.try_divide(shared, offered).alias(f"{side}_{kind}_ratio"),
            ]
    return columns


def _total(values: Column, scores: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, value: acc + F.element_at(scores, value))


def score_totals() -> list[Column]:
    """Sum of a user's scores per kind, added in the order of a menu's values."""
    return [_total(F.sort_array(F.map_keys(f"{kind}_scores")), F.col(f"{kind}_scores")).alias(f"{kind}_total") for kind in KINDS]


def affinity_columns() -> list[Column]:
    """Mean of the user's scores over the shared values; null when there are none.

    A look-up costs a walk through the user's values. A menu that has all of them needs none, as the sum is the user's
    total then; a menu with few has few to look up.
    """

    def mean(side: str, kind: str) -> Column:
        shared, scores = F.col(f"{side}_{kind}_shared"), F.col(f"{kind}_scores")
        total = F.when(F.size(shared) == F.size(scores), F.col(f"{kind}_total")).otherwise(_total(shared, scores))
        return F.try_divide(total, F.size(shared))

    return [mean(side, kind).alias(f"{side}_avg_score_on_{name}") for kind, name in KINDS.items() for side in SIDES]


_ROW_KEY = ("user_id", "menu_id", "train_date")


def _rows(ratings, menu_feedback, dim_menu_food, day, users=None):
    """Labels with the user's profile and the day's sets side by side.

    Both come as staged tables with one row per key: a user or a date may have very many labels.
    """
    dim_menu_food = with_codes(dim_menu_food)
    # A row per date. Staged, so that Spark knows its size and leaves the dishes and the feedback where they are.
    pairs = stage(menu_pairs(dish_menus(dim_menu_food), day), "menu-pairs")
    labels = choice_labels(menu_feedback, pairs)
    if day is not None:
        # One date needs the feedback on its menus and the ratings of the users who gave it.
        menus = stage(pair_members(pairs).select("menu_id"), "day-menus")
        labels = stage(choice_labels(menu_feedback.join(menus, "menu_id", "left_semi"), pairs), "day-labels")
        ratings = ratings.join(stage(labels.select("user_id").distinct(), "day-users"), "user_id", "left_semi")
    profiles = taste_profiles(ratings, dim_menu_food).select("*", *score_totals())
    if users is not None:
        profiles = profiles.join(users, "user_id", "left")
    rows = (
        labels.join(stage(profiles, "profiles"), "user_id")
        .join(stage(menu_sets(dim_menu_food, pairs), "menu-sets"), "train_date")
    )
    return with_shared_values(rows)


def ab_overlap_features(
    ratings: DataFrame, menu_feedback: DataFrame, dim_menu_food: DataFrame, day: str | None = None
) -> DataFrame:
    return _rows(ratings, menu_feedback, dim_menu_food, day).select(*_ROW_KEY, *overlap_columns())


def ab_affinity_scores(
    ratings: DataFrame, menu_feedback: DataFrame, dim_menu_food: DataFrame, day: str | None = None
) -> DataFrame:
    return _rows(ratings, menu_feedback, dim_menu_food, day).select(*_ROW_KEY, *affinity_columns())


def ab_training_rows(
    ratings: DataFrame,
    menu_feedback: DataFrame,
    dim_menu_food: DataFrame,
    users: DataFrame,
    day: str | None = None,
    as_of_year: int = AS_OF_YEAR,
) -> DataFrame:
    """Training rows for the menu choice, keyed by user, date and reviewed menu."""
    people = users.select(
        "user_id", F.col("gender").alias("user_gender"), (F.lit(as_of_year) - F.col("birth_year")).alias("user_age")
    )
    rows = _rows(ratings, menu_feedback, dim_menu_food, day, people).select(
        *_ROW_KEY, "user_gender", "user_age", *overlap_columns(), *affinity_columns(), "menu_regret", "pre_vote", "label"
    )
    return contract("xgb_train_data").enforce(rows)
