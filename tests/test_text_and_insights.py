import datetime as dt

import pytest
from pyspark.sql import functions as F

from mealmarts.functions import columns
from mealmarts.operators.loads import stamp
from mealmarts.plans import insights, monthly_marts, user_marts
from mealmarts.plans.review_words import review_words


def test_review_words(spark, rows_of):
    text = "김치찌개 정말 맛있어요! 김치찌개, kimchi-stew... 또 x 7 맛 12"
    df = spark.createDataFrame(
        [(1, text, "2025-05-01"), (1, "김치찌개", "2025-05-01"), (1, None, "2025-05-01"), (2, "국물 국물", "soon"), (2, "국물", None)],
        "user_id long, menu_comment string, comment_date string",
    )
    may = dt.date(2025, 5, 1)
    got = rows_of(review_words(df))
    assert got == sorted([
        (1, "김치찌개", may, 3), (1, "맛있어요", may, 1), (1, "kimchi", may, 1), (1, "stew", may, 1), (1, "12", may, 1),
        (2, "국물", dt.date(1970, 1, 1), 2),
    ], key=repr)
    assert rows_of(user_marts.user_review_word(review_words(df).filter("user_id = 2"))) == [(2, "국물", 2)]


def test_long_comments_count_whole(spark):
    df = spark.createDataFrame([(1, "ab cd " * 30_000, dt.date(2025, 5, 1))], "user_id long, menu_comment string, comment_date date")
    assert {r.word: r["count"] for r in review_words(df).collect()} == {"ab": 30_000, "cd": 30_000}


def test_own_tokenizer(spark, rows_of):
    df = spark.createDataFrame([(1, "a1|b2|a1", dt.date(2025, 5, 1))], "user_id long, menu_comment string, comment_date date")
    got = rows_of(review_words(df, lambda text: F.split(text, r"\|")), "word", "count")
    assert got == [("a1", 2), ("b2", 1)]


def test_latest_insight(spark, rows_of):
    df = spark.createDataFrame([(1, "old"), (1, "new"), (2, "only")], "user_id long, insight string")
    dated = stamp(df.filter("insight = 'old'"), "insight_date", "2025-05-01").unionByName(
        stamp(df.filter("insight <> 'old'"), "insight_date", "2025-05-02")
    )
    assert rows_of(user_marts.user_insight_latest(dated)) == [(1, "new"), (2, "only")]


@pytest.fixture(scope="module")
def facts(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 5.0), (1, 2, 4.5), (1, 3, 3.0), (1, 4, 1.0), (2, 1, 2.0), (3, 99, 2.0)],
        "user_id long, food_id long, food_score double",
    )
    attributes = spark.createDataFrame(
        [(1, "stew", "soup", "hot"), (2, "bibim", "rice", "hot"), (3, "gim", "rice", "salty"), (4, "tofu", None, None)],
        "food_id long, food_name string, category_name string, tag_name string",
    )
    users = spark.createDataFrame([(1, "m", 1998), (2, None, 1985), (3, "f", None)], "user_id long, gender string, birth_year int")
    return ratings, attributes, users


def test_prompt(facts):
    prompts = {r.user_id: r.prompt for r in insights.insight_prompt(insights.context_from_facts(*facts)).collect()}
    # User 3 rated only a dish that is on no menu: no tag, no prompt.
    assert set(prompts) == {1, 2}
    assert "- stew (5.0점)\n- bibim (4.5점)\n- gim (3.0점)\n" in prompts[1]
    assert "Most rated tag: hot (2)" in prompts[1] and "Most rated category: rice (2)" in prompts[1]
    assert "Mean score: 2.0 (everyone: 3.1)" in prompts[2]


def test_prompt_stand_ins_and_own_template(facts):
    context = insights.context_from_facts(*facts).filter("user_id = 1").withColumns(
        {"top_tag": F.lit(None).cast("string"), "top_food_lines": F.lit(None).cast("string"), "user_avg_score": F.lit(None).cast("double")}
    )
    text = insights.insight_prompt(context, "{top_tag}|{top_food_lines}|{user_avg_score}|{top_tag_count} end").first().prompt
    assert text == "없음|- 없음|N/A|2 end"
    with pytest.raises(ValueError, match="unknown prompt field"):
        insights.insight_prompt(context, "{nobody}")


def test_groups(facts, rows_of):
    got = rows_of(user_marts.user_group_comparison(*facts), "user_id", "group_type", "group_value", "group_avg_score", "group_diversity_score")
    everyone = (3.1, 2)
    assert got == [
        (1, "age", "2", 3.375, 2), (1, "all", "all", *everyone), (1, "gender", "m", 3.375, 2),
        (2, "age", "4", 2.0, 1), (2, "all", "all", *everyone),
    ]
    assert (None, 2.0) in rows_of(user_marts.group_stats(*facts).filter("group_type = 'gender'"), "group_value", "group_avg_score")


def test_attribute_counts_keep_a_missing_attribute(facts, rows_of):
    assert (1, None, 1) in rows_of(user_marts.user_tag_stats(*facts[:2]))


def test_column_helpers(spark):
    row = spark.sql("SELECT DATE'2025-01-31' AS d, '12기' AS a, 'x' AS b, CAST(NULL AS STRING) AS c").select(
        columns.previous_month("d").alias("p"), columns.leading_int("a").alias("a"), columns.leading_int("b").alias("b"), columns.leading_int("c").alias("c"),
    ).first()
    assert tuple(row) == ("2024-12", 12, 0, None)
    assert columns.month_bounds("2024-12") == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))


def test_month_edges_and_push_down(spark, table):
    stamps = [dt.datetime(2025, 4, 30, 23, 59, 59), dt.datetime(2025, 5, 1), dt.datetime(2025, 5, 31, 23, 59, 59), dt.datetime(2025, 6, 1)]
    df = table("food_review", [(i, 1, 1, 1.0, s) for i, s in enumerate(stamps)])
    assert [r.id for r in columns.in_month(df, "timestamp", "2025-05").collect()] == [1, 2]
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = columns.in_month(orders, "o_orderdate", "1997-05")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_statistics_edges(table):
    noon = dt.datetime(2025, 5, 15)
    empty = monthly_marts.monthly_statistic(table("food_review", []), "2025-05").collect()
    assert len(empty) == 1 and empty[0].month == "2025-05" and empty[0].avg is None
    # Variance 10.125 has no place in two digits before the point: null, not a failed job.
    wide = monthly_marts.monthly_statistic(table("food_review", [(1, 1, 1, 0.5, noon), (2, 1, 1, 5.0, noon)]), "2025-05").first()
    assert wide.variance is None and (wide.min, wide.max) == (0, 5)


def test_null_means_rank_worst_first(table):
    noon = dt.datetime(2025, 5, 15)
    foods = table("food", [(f, f"f{f}", "x", "c", "t") for f in (1, 2)])
    df = monthly_marts.monthly_food_ranking(table("food_review", [(1, 1, 1, None, noon), (2, 1, 2, 4.0, noon), (3, 1, 3, 1.0, noon)]), foods, "2025-05")
    assert {(r.rank_type, r["rank"]): r.food_id for r in df.collect()} == {("best", 1): 2, ("best", 2): 1, ("worst", 1): 1, ("worst", 2): 2}


def test_series_is_running(table, rows_of):
    reviews = table("menu_review", [(i, i % 2, 1, 1.0, 0, None, dt.datetime(2025, 3 + i % 3, 2)) for i in range(7)])
    votes, menus = table("pre_vote", [(1, 1, 5), (2, 1, 6)]), table("menu", [(1, dt.date(2025, 5, 5))])
    got = rows_of(monthly_marts.monthly_count_series(reviews, votes, menus))
    assert got == [("2025-03", 3, 3, 3), ("2025-04", 2, 5, -1), ("2025-05", 4, 9, 2)]
    one = rows_of(monthly_marts.monthly_count(reviews, votes, menus, "2025-05"))
    assert one == [(4, 4, 4)]


def test_every_gender_code_is_a_group(spark, rows_of):
    ratings = spark.createDataFrame([(1, 1, 2.0), (2, 1, 4.0), (3, 1, 3.0)], "user_id long, food_id long, food_score double")
    attributes = spark.createDataFrame([(1, "a", "c", "t")], "food_id long, food_name string, category_name string, tag_name string")
    users = spark.createDataFrame([(1, "m", 1998), (2, "x", 1998), (3, "f", 1998)], "user_id long, gender string, birth_year int")
    groups = user_marts.group_stats(ratings, attributes, users).filter("group_type = 'gender'")
    assert rows_of(groups, "group_value", "group_avg_score") == [("f", 3.0), ("m", 2.0), ("x", 4.0)]
    own = user_marts.user_group_comparison(ratings, attributes, users).filter("group_type = 'gender'")
    assert rows_of(own, "user_id", "group_value") == [(1, "m"), (2, "x"), (3, "f")]
