"""What is known about a user's taste, and the prompt text built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mealmarts.functions.columns import mean_from
from mealmarts.operators.ranking import one_per_key
from mealmarts.plans import user_marts
from mealmarts.plans.warehouse import rated_users
from mealmarts.session import stage

# List length, stand-ins for what is missing, and the shape of a food line.
TOP_FOODS = 3
NOTHING = "없음"
NOT_AVAILABLE = "N/A"
NO_FOODS = f"- {NOTHING}"
FOOD_LINE = "- %s (%s점)"

PROMPT_FIELDS = (
    "user_id", "top_food_lines", "top_tag", "top_tag_count", "top_category", "top_category_count",
    "user_avg_score", "group_avg_score", "user_diversity_score", "group_diversity_score",
)

PROMPT_TEMPLATE = """User {user_id}: write a short, friendly note on this diner's taste.
Best rated dishes:
{top_food_lines}
Most rated tag: {top_tag} ({top_tag_count})
Most rated category: {top_category} ({top_category_count})
Mean score: {user_avg_score} (everyone: {group_avg_score})
Categories tried: {user_diversity_score} (everyone: {group_diversity_score})"""


def _most_counted(counts: DataFrame, value: str) -> DataFrame:
    order = [F.col("count").desc(), F.col(value).asc_nulls_last()]
    return one_per_key(counts, ["user_id"], order).select(
        "user_id", F.col(value).alias(f"top_{value}"), F.col("count").alias(f"top_{value}_count")
    )


def _food_lines(rank: DataFrame) -> DataFrame:
    """Best dishes as one text per user; the list holds three rows, so it is short by definition."""
    best = rank.filter((F.col("score_type") == "best") & (F.col("rank_order") <= TOP_FOODS))
    line = F.format_string(
        FOOD_LINE,
        F.coalesce("food_name", F.lit("None")),
        F.coalesce(F.col("food_score").cast("string"), F.lit("None")),
    )
    lines = best.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank_order", line.alias("line")))).alias("l"))
    return lines.select("user_id", F.array_join(F.col("l.line"), "\n").alias("top_food_lines"))


def insight_context(
    ratings: DataFrame,
    food_rank: DataFrame,
    tag_stats: DataFrame,
    category_stats: DataFrame,
    comparison: DataFrame,
) -> DataFrame:
    """One row per user who rated a dish; what a mart does not know about them stays null."""
    everyone = comparison.filter(F.col("group_type") == "all").select(
        "user_id", "user_avg_score", "group_avg_score", "user_diversity_score", "group_diversity_score"
    )
    context = rated_users(ratings)
    for part in (
        _food_lines(food_rank),
        _most_counted(tag_stats, "tag"),
        _most_counted(category_stats, "category"),
        everyone,
    ):
        context = context.join(part, "user_id", "left")
    return context.select(*PROMPT_FIELDS)


def context_from_facts(
    ratings: DataFrame, attributes: DataFrame, users: DataFrame, as_of_year: int = user_marts.AS_OF_YEAR
) -> DataFrame:
    """Context straight from the facts, without stored marts.

    Ratings are read twice: for the best dishes, and for cells of user, tag and category. A user has a
    bounded number of cells; both counts, the user's figures and everyone's follow from them.
    """
    cells = stage(
        ratings.join(attributes.select("food_id", F.col("tag_name").alias("tag"), F.col("category_name").alias("category")), "food_id")
        .groupBy("user_id", "tag", "category")
        .agg(F.count("*").alias("count"), F.sum("food_score").alias("total"), F.count("food_score").alias("n")),
        "taste-cells",
    )
    context = _food_lines(user_marts.best_foods(ratings, attributes, TOP_FOODS))  # every user who rated a dish has one
    for value in ("tag", "category"):
        counts = cells.groupBy("user_id", value).agg(F.sum("count").alias("count"))
        context = context.join(_most_counted(counts, value), "user_id", "left")
    known = cells.join(users.select("user_id"), "user_id")
    own = known.groupBy("user_id").agg(
        mean_from(F.col("total"), F.col("n")).alias("user_avg_score"), F.count_distinct("category").alias("user_diversity_score")
    )
    everyone = known.groupBy(F.lit("all").alias("group_type")).agg(
        mean_from(F.col("total"), F.col("n")).alias("group_avg_score"), F.count_distinct("category").alias("group_diversity_score")
    )
    own = own.withColumn("group_type", F.lit("all")).join(stage(everyone, "everyone"), "group_type")  # one row
    return context.join(own, "user_id", "left").select(*PROMPT_FIELDS)


def _filled(name: str) -> Column:
    missing = {"top_food_lines": NO_FOODS, "top_tag": NOTHING, "top_category": NOTHING}.get(name, NOT_AVAILABLE)
    return F.coalesce(F.col(name).cast("string"), F.lit(missing))


def insight_prompt(context: DataFrame, template: str = PROMPT_TEMPLATE) -> DataFrame:
    """Prompt per user. Users without a tag, category or comparison row are left out.

    The template is cut at its fields and put together by one ``concat`` expression.
    """
    known = context.filter(
        F.col("top_tag_count").isNotNull()
        & F.col("top_category_count").isNotNull()
        & F.col("group_diversity_score").isNotNull()
    )
    pieces, rest = [], template
    while rest:
        text, brace, tail = rest.partition("{")
        pieces += [F.lit(text)] if text else []
        if not brace:
            break
        name, _, rest = tail.partition("}")
        if name not in PROMPT_FIELDS:
            raise ValueError(f"unknown prompt field: {name}")
        pieces.append(_filled(name))
    return known.select("user_id", F.concat(*pieces).alias("prompt"))
