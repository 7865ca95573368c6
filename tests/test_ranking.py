import random

from pyspark.sql import functions as F

from mealmarts.operators.ranking import greatest_row, number_rows, one_per_key, top_n
from mealmarts.plans import user_marts


def test_number_rows_over_groups(spark):
    rng = random.Random(3)
    # One group holds most of the rows.
    rows = [("hot" if i % 10 < 7 else f"g{i % 3}", rng.randrange(5), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, score int, id long").repartition(7)
    got = number_rows(df, [F.col("score").desc(), F.col("id")], "rank", ["g"]).collect()
    want = {}
    for group in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))
        want |= {r[2]: i for i, r in enumerate(ordered, start=1)}
    assert {r.id: r["rank"] for r in got} == want


def test_number_rows_of_a_whole_table(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.lpad("id", 5, "0")).alias("k")).repartition(5)
    got = {r.k: r.idx for r in number_rows(df, [F.col("k")], "idx", start=0).collect()}
    assert got == {f"k{i:05d}": i for i in range(1000)}


def test_number_rows_of_nothing(spark):
    assert number_rows(spark.range(0), [F.col("id")], "n").count() == 0


def test_top_n_cuts_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("g"), "id")
    top = top_n(df, ["g"], [F.col("id").desc()], 2, "n")
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted((r.g, r.id, r.n) for r in top.collect()) == [
        (0, 9996, 2), (0, 9999, 1), (1, 9994, 2), (1, 9997, 1), (2, 9995, 2), (2, 9998, 1),
    ]


def test_one_per_key(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (2, None)], "k int, v int")
    assert sorted(map(tuple, one_per_key(df, ["k"], [F.col("v").desc_nulls_last()]).collect())) == [(1, 5), (2, None)]


def test_user_with_few_foods_is_in_both_lists(spark, rows_of):
    ratings = spark.createDataFrame([(1, f, s) for f, s in ((1, 5.0), (2, 5.0), (3, None), (4, 1.0))], "user_id long, food_id long, food_score double")
    names = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "food_id long, food_name string")
    got = rows_of(user_marts.user_food_rating_rank(ratings, names), "score_type", "rank_order", "food_name")
    assert got == [
        ("best", 1, "a"), ("best", 2, "b"), ("best", 3, "d"), ("best", 4, None),
        ("worst", 1, None), ("worst", 2, "d"), ("worst", 3, "a"), ("worst", 4, "b"),
    ]


def test_greatest_row_keeps_columns_together(spark):
    rows = [(1, 5, None, "z"), (1, 5, 2.0, "a"), (1, 4, 9.0, "q"), (2, None, None, None)]
    df = spark.createDataFrame(rows, "k int, id int, score double, text string")
    got = sorted(map(tuple, greatest_row(df, ["k"], ["id", "score", "text"]).collect()))
    assert got == [(1, 5, 2.0, "a"), (2, None, None, None)]
