import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mealmarts.schemas import CONTRACTS  # noqa: E402
from mealmarts.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Rows as a frame of a contract's type."""

    def make(name, rows):
        return spark.createDataFrame(rows, CONTRACTS[name].schema)

    return make


@pytest.fixture
def rows_of():
    def rows(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return rows


TODAY = dt.date(2025, 5, 15)
NOON = dt.datetime(2025, 5, 15)


def days_ago(n):
    return TODAY - dt.timedelta(days=n)


@pytest.fixture(scope="session")
def cafeteria(table):
    """Three users, six menus on three days."""
    users = [9, 10, 11]
    # Scores and votes.
    menu_scores = {(9, 1): 3.5, (9, 4): 4.0, (9, 5): 1.0, (10, 1): 3.5, (10, 4): 4.0, (10, 5): 3.0,
                   (11, 1): 4.5, (11, 4): 2.0, (11, 5): 3.0}
    votes = [(1, 1, 9), (2, 4, 9), (3, 5, 9), (4, 2, 10), (5, 4, 10), (6, 5, 10), (7, 1, 11), (8, 3, 11), (9, 5, 11)]
    food_scores = {9: [2.0, 1.0, 1.5, 2.5, 2.0, 3.0], 10: [5.0] * 6, 11: [1.0] * 6}
    feedback = [
        (9, 1, 2, [4.5, 5.0, 2.5, 1.0, 1.5, 3.0]), (9, 19, 1, [4.5, 5.0, 4.0, 5.0, 3.5, 3.5]),
        (10, 7, 2, [4.0] * 6), (10, 19, 1, [5.0] * 6),
        (11, 1, 2, [2.0] * 6), (11, 13, 1, [1.0] * 6),
    ]
    reviews = [
        (i, u, m, s, int(m == 5), "맛", NOON) for i, ((u, m), s) in enumerate(menu_scores.items(), start=1)
    ]
    ratings = [
        (6 * k + i + 1, u, 25 + i, s, NOON) for k, u in enumerate(users) for i, s in enumerate(food_scores[u])
    ]
    return {
        "account": table("account", [
            (u, f"user{u:02d}", g, dt.date(y, 3, 1), "12기", "3반", "서울")
            for u, g, y in ((9, "M", 1998), (10, "F", 1996), (11, "M", 1986))
        ]),
        "food": table("food", [
            (f, f"food{f:02d}", ("주메뉴", "서브메뉴", "국")[f % 3], f"cat{f % 3}", f"tag{f % 4}") for f in range(1, 37)
        ]),
        "menu": table("menu", [(m, days_ago((6 - m) // 2)) for m in range(1, 7)]),
        "menu_food": table("menu_food", [((f + 5) // 6, f) for f in range(1, 37)]),
        "menu_review": table("menu_review", reviews),
        "food_review": table("food_review", ratings),
        "pre_vote": table("pre_vote", votes),
        "fact_food": table("fact_user_food_feedback", [
            (u, first + i, s, days_ago(ago)) for u, first, ago, scores in feedback for i, s in enumerate(scores)
        ]),
    }
