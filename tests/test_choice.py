"""Menu-choice rows against a plain computation on a small fixture with awkward values."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mealmarts.plans import choice, models
from mealmarts.operators import metrics

D1, D2, D3 = (dt.date(2025, 5, d) for d in (1, 2, 3))
TAGS = {1: "spicy", 2: "sweet", 3: None, 4: "spicy", 5: "salty", 6: "sweet", 7: "sour"}
CATS = {1: "soup", 2: "rice", 3: "soup", 4: "noodle", 5: None, 6: "rice", 7: "soup"}
MENUS = {11: (D1, [1, 2, 3]), 12: (D1, [4, 5, 1]), 21: (D2, [6, 3]), 22: (D2, [2, 7, 5]), 31: (D3, [1, 2])}
PAIRS = {D1: (11, 12), D2: (21, 22)}


@pytest.fixture(scope="module")
def data(table):
    rng = random.Random(5)
    # User 1 holds most ratings; user 4 only liked a dish without tag; food 99 is on no menu.
    ratings = [(1, rng.choice([1, 2, 3, 4, 5, 6, 7, 99]), rng.randrange(1, 11) / 2, dt.date(2025, 4, 1 + i % 30)) for i in range(90)]
    ratings += [(u, f, rng.randrange(1, 11) / 2, D1) for u in (2, 3) for f in (1, 2, 4, 5, 7, 99)]
    ratings += [(4, 3, 5.0, D1), (4, 1, 1.0, D1), (5, 1, None, D1)]
    feedback = [
        (1, 11, 4.0, 0, "x", 1, D1), (1, 12, 3.0, 1, None, 0, D1), (2, 22, 2.5, 0, None, 0, D2), (2, 21, None, 0, None, 0, D2),
        (3, 31, 2.0, 0, None, 1, D3), (4, 21, 1.0, 1, None, 1, D3), (5, 11, 1.0, 1, None, 1, D1), (9, 11, 5.0, 0, None, 0, D1),
    ]
    dishes = [(m, day, f, f"f{f}", "etc", CATS[f], TAGS[f]) for m, (day, foods) in MENUS.items() for f in foods]
    return {
        "ratings": ratings, "feedback": feedback,
        "frames": (
            table("fact_user_food_feedback", ratings),
            table("fact_user_menu_feedback", feedback),
            table("dim_menu_food_combined", dishes),
            table("dim_user", [(u, "m" if u % 2 else "f", 1990 + u, 1, 1, "x") for u in (1, 2, 3, 4)]),
        ),
    }


def plain_scores(ratings, attribute):
    by_user = defaultdict(list)
    for user, food, score, _ in ratings:
        if score is not None:
            by_user[user].append((food, score))
    out = defaultdict(lambda: defaultdict(list))
    for user, rated in by_user.items():
        mean = sum(s for _, s in rated) / len(rated)
        for food, score in rated:
            for _, foods in MENUS.values():
                if score >= mean and food in foods:
                    out[user][attribute[food]].append(score)
    return {u: {a: sum(s) / len(s) for a, s in values.items()} for u, values in out.items()}


def test_training_rows_equal_plain_computation(data):
    got = {(r.user_id, r.menu_id): r for r in choice.ab_training_rows(*data["frames"]).collect()}
    scores = {kind: plain_scores(data["ratings"], a) for kind, a in (("tag", TAGS), ("category", CATS))}
    want = [
        (row, day, label)
        for row in data["feedback"] if row[2] is not None and row[0] in scores["tag"]
        for day, pair in PAIRS.items() for label, menu in enumerate(pair) if menu == row[1]
    ]
    assert set(got) == {(row[0], row[1]) for row, _, _ in want} and len(want) == 4
    for row, day, label in want:
        r = got[row[0], row[1]]
        assert (r.label, r.train_date, r.menu_regret, r.pre_vote) == (label, day, row[3], row[5])
        assert (r.user_gender, r.user_age) == ("m" if row[0] % 2 else "f", 2025 - 1990 - row[0])
        for side, menu in zip("AB", PAIRS[day]):
            for kind, attribute, plural in (("tag", TAGS, "tags"), ("category", CATS, "categories")):
                offered = {attribute[f] for f in MENUS[menu][1]}
                mine = {a: s for a, s in scores[kind][row[0]].items() if a is not None}
                shared = [mine[a] for a in offered if a in mine]
                assert r[f"{side}_{kind}_overlap"] == len(shared)
                assert r[f"{side}_{kind}_ratio"] == pytest.approx(len(shared) / len(offered))
                mean = r[f"{side}_avg_score_on_{plural}"]
                assert mean == (pytest.approx(sum(shared) / len(shared)) if shared else None)


def test_one_date_is_a_slice(data, rows_of):
    everything = choice.ab_training_rows(*data["frames"])
    for day in ("2025-05-01", "2025-05-02", "2025-05-03"):
        one = choice.ab_training_rows(*data["frames"], day=day)
        assert rows_of(one) == rows_of(everything.filter(f"train_date = DATE'{day}'"))


def test_gate_and_pairs_leave_out_single_menu_dates(data, rows_of):
    menus = choice.dish_menus(data["frames"][2])
    assert rows_of(choice.ab_gate(menus)) == [(D1, 2), (D2, 2)]
    assert rows_of(choice.menu_pairs(menus)) == [(D1, 11, 12), (D2, 21, 22)]


def test_preferences_drop_missing_attributes(data):
    prefs = {r.user_id: r for r in choice.user_preferences(choice.taste_profiles(*data["frames"][::2])).collect()}
    assert (prefs[4].user_tags, prefs[4].user_cats) == ([], ["soup"])
    assert 5 not in prefs


def test_menu_comparison(cafeteria, spark):
    features = choice.menu_features(cafeteria["menu_food"], choice.food_features(cafeteria["food"], cafeteria["food_review"]))
    rows = choice.menu_comparison(cafeteria["menu_review"], cafeteria["menu"], cafeteria["account"], features).collect()
    # All reviews are of the last day, whose menus are 5 and 6.
    assert len(rows) == 9 and {(r.menu_id_a, r.menu_id_b) for r in rows} == {(5, 6)}
    assert {(r.chosen_menu_id, r.label) for r in rows} == {(1, 1), (4, 1), (5, 0)}
    one = rows[0]
    assert one.review_count_a == 6 and one.review_count_b == 0
    dishes = choice.menu_dishes(cafeteria["menu_food"], choice.food_features(cafeteria["food"], cafeteria["food_review"]))
    assert sorted(r.food_id for r in dishes.filter(f"menu_id = {one.menu_id_a}").collect()) == [25, 26, 27, 28, 29, 30]
    day = str(one.date)
    of_day = choice.menu_comparison(cafeteria["menu_review"], cafeteria["menu"], cafeteria["account"], features, day).collect()
    assert sorted(of_day) == sorted(r for r in rows if str(r.date) == day)
    assert one.avg_food_score_a == pytest.approx(48 / 18) and one.avg_food_score_b is None
    assert {r.user_id: r.age for r in rows} == {9: 27, 10: 29, 11: 39}
    counts = {r.menu_id: r.total_reviews for r in features.collect()}
    assert counts[5] == 18 and counts[6] is None


def test_gbt_scores_every_row(data):
    rows = choice.ab_training_rows(*data["frames"]).cache()
    model = models.train_gbt(rows, maxIter=2, maxDepth=2)
    scored = models.predict_gbt(model, rows)
    assert scored.count() == rows.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored.collect())
    measures = models.gbt_metrics(scored).first()
    assert 0 <= measures.accuracy <= 1


def test_holdout_is_repeatable(spark):
    rows = spark.range(2000).selectExpr("id AS user_id", "DATE'2025-05-01' AS train_date", "id AS menu_id")
    held = rows.filter(models.in_holdout(0.25))
    assert held.count() == held.repartition(9).count() and 400 < held.count() < 600


@pytest.mark.parametrize(
    ("pairs", "want"),
    [
        ([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], (3 / 5, 2 / 3, 2 / 3, 2 / 3)),
        ([(0, 0), (1, 0)], (0.5, 0.0, 0.0, 0.0)),
        ([(0, 0)], (1.0, 0.0, 0.0, 0.0)),
        ([], (0.0, 0.0, 0.0, 0.0)),
    ],
)
def test_binary_metrics(spark, pairs, want):
    df = spark.createDataFrame(pairs, "label int, predicted int")
    r = metrics.binary_metrics(df, "label", "predicted").first()
    assert (r.accuracy, r.precision, r.recall, r.f1_score) == pytest.approx(want)


def test_rmse(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")
    assert metrics.rmse(df, "label", "score").first().rmse == pytest.approx(0.5)


def test_codes_follow_names_and_keep_nulls(data):
    """Dishes with numbers for names, numbered as the names sort; a menu's values come in that order."""
    dishes = data["frames"][2]
    coded = choice.with_codes(dishes)
    both = dishes.join(coded.select("menu_id", "food_id", F.col("tag_name").alias("t"), F.col("category_name").alias("c")), ["menu_id", "food_id"])
    rows = both.collect()
    assert len(rows) == dishes.count() == coded.count()
    for name, code in (("tag_name", "t"), ("category_name", "c")):
        want = {v: i for i, v in enumerate(sorted({r[name] for r in rows} - {None}), start=1)} | {None: None}
        assert all(r[code] == want[r[name]] for r in rows)
    sets = choice.menu_sets(coded, choice.menu_pairs(choice.dish_menus(coded))).collect()
    assert sets and all(list(r[c]) == sorted(r[c]) for r in sets for c in r.asDict() if c.endswith("_set"))


def test_a_mean_is_the_same_with_all_values_shared_or_some(spark):
    """Menus with all, some and none of a user's values, against sums by hand."""
    scores = {3: 0.1, 1: 0.2, 2: 0.3}
    rows = spark.createDataFrame([(i, scores, s) for i, s in enumerate(([1, 2, 3], [1, 2, 3, 4], [2, 4], [4]))], "i int, scores map<int,double>, offered array<int>")
    named = rows.selectExpr("i", *[f"scores AS {k}_scores" for k in choice.KINDS], *[f"offered AS {s}_{k}_set" for k in choice.KINDS for s in choice.SIDES])
    got = choice.with_shared_values(named.select("*", *choice.score_totals())).select("i", *choice.affinity_columns()).orderBy("i").collect()
    everything = (0.0 + 0.2 + 0.3 + 0.1) / 3
    assert [list(r)[1:] for r in got] == [[everything] * 4, [everything] * 4, [0.3] * 4, [None] * 4]
