"""Known results of the small cafeteria."""

from decimal import Decimal

import pytest

from mealmarts.plans import monthly_marts, user_marts, warehouse

MONTH = "2025-05"


def test_user_summary(cafeteria, rows_of):
    feedback = warehouse.menu_feedback(cafeteria["menu_review"], cafeteria["pre_vote"])
    got = rows_of(user_marts.user_summary(cafeteria["fact_food"], feedback))
    assert [(u, round(s, 6), n, v) for u, s, n, v in got] == [
        (10, 4.5, 12, 2), (11, 1.5, 12, 2), (9, 3.583333, 12, 3),
    ]


def test_monthly_statistic(cafeteria, rows_of):
    got = rows_of(monthly_marts.monthly_statistic(cafeteria["food_review"], MONTH))
    assert got == [(MONTH, 1, 5, Decimal("2.67"), 1, 5, Decimal("3.21"), Decimal("1.79"))]


def test_monthly_food_ranking(cafeteria):
    df = monthly_marts.monthly_food_ranking(cafeteria["food_review"], cafeteria["food"], MONTH)
    ranked = {(r.rank_type, r["rank"]): (r.food_id, r.avg_score) for r in df.collect()}
    assert [ranked["best", i] for i in range(1, 6)] == [
        (30, Decimal("3.00")), (28, Decimal("2.83")), (25, Decimal("2.67")), (29, Decimal("2.67")), (27, Decimal("2.50")),
    ]
    assert [ranked["worst", i][0] for i in range(1, 6)] == [26, 27, 25, 29, 28]
    assert ranked["worst", 1][1] == Decimal("2.33")


def test_monthly_count(cafeteria, rows_of):
    sources = [cafeteria[t] for t in ("menu_review", "pre_vote", "menu")]
    assert rows_of(monthly_marts.monthly_count(*sources, MONTH)) == [(18, 18, 18)]
    assert rows_of(monthly_marts.monthly_count(*sources, "2025-06")) == [(0, 0, 0)]
    assert rows_of(monthly_marts.cumulative_distinct_evaluators(*sources[:2])) == [(3,)]


@pytest.mark.parametrize("month", [MONTH, None])
def test_monthly_frequent_evaluator(cafeteria, rows_of, month):
    df = monthly_marts.monthly_frequent_evaluator(
        *[cafeteria[t] for t in ("food_review", "pre_vote", "menu", "account")], month
    )
    assert rows_of(df, "rank", "name", "evaluates") == [(1, "user09", 9), (2, "user10", 9), (3, "user11", 9)]


def test_dim_user_reads_leading_digits(cafeteria, rows_of):
    got = rows_of(warehouse.dim_user(cafeteria["account"]))
    assert got[0] == (10, "f", 1996, 12, 3, "서울")


def test_dim_menu_food_recodes(cafeteria):
    df = warehouse.dim_menu_food(cafeteria["menu_food"], cafeteria["food"], cafeteria["menu"])
    codes = {(r.food_id, r.main_sub) for r in df.collect()}
    assert {(3, "main"), (4, "sub"), (5, "etc")} <= codes and len(codes) == 36
