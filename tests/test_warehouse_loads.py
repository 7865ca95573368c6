import datetime as dt

import pytest

from mealmarts.operators import loads, quality
from mealmarts.plans import warehouse
from mealmarts.schemas import CONTRACTS, contract
from mealmarts.session import scratch_path

MAY1, MAY2 = dt.date(2025, 5, 1), dt.date(2025, 5, 2)


@pytest.fixture
def sides(spark):
    schema = "id long, v string, n int"
    target = spark.createDataFrame([(1, "a", 1), (2, "b", None)], schema)
    batch = spark.createDataFrame([(2, None, 9), (3, "x", 1), (3, "y", 2)], schema)
    return target, batch


def test_ignore_keeps_existing_and_first(sides, rows_of):
    got = rows_of(loads.load_ignore(*sides, ["id"], "n"))
    assert got == [(1, "a", 1), (2, "b", None), (3, "x", 1)]


def test_upsert_replaces_with_last_and_its_nulls(sides, rows_of):
    got = rows_of(loads.load_upsert(*sides, ["id"], "n"))
    assert got == [(1, "a", 1), (2, None, 9), (3, "y", 2)]


@pytest.mark.parametrize("strategy", [loads.load_ignore, loads.load_upsert])
def test_loading_twice_changes_nothing(sides, rows_of, strategy):
    target, batch = sides
    once = strategy(target, batch, ["id"], "n")
    assert rows_of(strategy(once, batch, ["id"], "n")) == rows_of(once)


def test_append_refuses_known_and_repeated_keys(sides):
    target, batch = sides
    with pytest.raises(loads.DuplicateKeyError):
        loads.load_append(target, batch, ["id"])
    with pytest.raises(loads.DuplicateKeyError):
        loads.load_append(target, batch.filter("id = 3"), ["id"])
    assert loads.load_append(target, batch.filter("v = 'x'"), ["id"]).count() == 3


def test_unknown_table_and_strategy(spark, table):
    rows = table("fact_user_food_feedback", [(1, 1, 2.0, MAY1)])
    with pytest.raises(ValueError, match="unknown table"):
        loads.store(rows, scratch_path(spark, "w"), "somewhere_else")
    with pytest.raises(ValueError, match="strategy"):
        loads.store(rows, scratch_path(spark, "w"), "fact_user_food_feedback", "replace")
    with pytest.raises(ValueError, match="missing columns"):
        contract("dim_user").enforce(rows)


def test_stored_table_strategies(spark, table, rows_of):
    name, root = "fact_user_food_feedback", scratch_path(spark, "warehouse")
    stored = lambda: rows_of(loads.read_table(spark, root, name))
    assert stored() == []
    loads.store(table(name, [(1, 1, 2.0, MAY1), (1, 2, 3.0, MAY2)]), root, name)
    with pytest.raises(loads.DuplicateKeyError):
        loads.store(table(name, [(1, 1, 5.0, MAY1)]), root, name)
    loads.store(table(name, [(1, 1, 5.0, MAY1), (2, 1, 4.0, MAY1)]), root, name, "ignore")
    assert stored() == [(1, 1, 2.0, MAY1), (1, 2, 3.0, MAY2), (2, 1, 4.0, MAY1)]
    loads.store(table(name, [(1, 1, 5.0, MAY1)]), root, name, "overwrite")
    assert stored() == [(1, 1, 5.0, MAY1), (1, 2, 3.0, MAY2), (2, 1, 4.0, MAY1)]


def test_day_reload_is_idempotent(spark, table, rows_of):
    name, root = "fact_user_food_feedback", scratch_path(spark, "warehouse")
    both = table(name, [(1, 1, 2.0, MAY1), (1, 2, 3.0, MAY2)])
    loads.replace_days(both, root, name)
    for _ in range(2):
        loads.replace_days(table(name, [(9, 9, 1.0, MAY2)]), root, name)
    assert rows_of(loads.read_table(spark, root, name)) == [(1, 1, 2.0, MAY1), (9, 9, 1.0, MAY2)]
    with pytest.raises(ValueError):
        loads.replace_days(table("dim_user", []), root, "dim_user")


def test_stored_dimension_without_partitions(spark, table, rows_of):
    root = scratch_path(spark, "warehouse")
    row = (1, "m", 1990, 1, 1, "x")
    loads.store(table("dim_user", [row]), root, "dim_user", "ignore")
    loads.store(table("dim_user", [(1, "f", 1991, 2, 2, "y"), (2, "f", 1992, 3, 3, "z")]), root, "dim_user", "ignore")
    assert rows_of(loads.read_table(spark, root, "dim_user")) == [row, (2, "f", 1992, 3, 3, "z")]


def test_repeat_ratings_and_votes(table, rows_of):
    noon, night = dt.datetime(2025, 5, 1, 12), dt.datetime(2025, 5, 1, 23, 59)
    ratings = table("food_review", [(1, 1, 7, 2.0, noon), (5, 1, 7, 3.0, night), (5, 1, 7, 3.5, noon), (6, 1, 7, None, dt.datetime(2025, 5, 2))])
    assert rows_of(warehouse.food_feedback(ratings)) == [(1, 7, 3.5, MAY1), (1, 7, None, MAY2)]
    assert rows_of(warehouse.food_feedback(ratings, "2025-05-01")) == [(1, 7, 3.5, MAY1)]
    reviews = table("menu_review", [(1, 1, 3, 4.0, 0, None, noon), (2, 2, 3, 4.0, 0, "ok", noon)])
    votes = table("pre_vote", [(1, 3, 1), (2, 3, 1), (3, 4, 2)])
    assert rows_of(warehouse.menu_feedback(reviews, votes), "user_id", "pre_vote") == [(1, 1), (2, 0)]


def test_day_is_a_slice_of_all_days(table, rows_of):
    rows = [(i, i % 3, i % 5, 1.0 + i % 4, dt.datetime(2025, 5, 1 + i % 3, i % 24)) for i in range(60)]
    ratings = table("food_review", rows)
    everything = warehouse.food_feedback(ratings)
    for day in (1, 2, 3):
        one = warehouse.food_feedback(ratings, f"2025-05-0{day}")
        assert rows_of(one) == rows_of(everything.filter(f"rating_date = DATE'2025-05-0{day}'"))


def test_repeated_account_takes_one_row(table):
    account = [(1, "a", g, dt.date(2000, 1, 1), "13기", "none", "x") for g in ("M", "F")]
    df = warehouse.dim_user(table("account", account))
    assert [tuple(r) for r in df.collect()] == [(1, "f", 2000, 13, 0, "x")]


def test_quality_reports(table, rows_of):
    fact = table("fact_user_food_feedback", [(1, 1, 1.0, MAY1), (1, 1, 2.0, MAY1), (2, 1, 1.0, MAY1), (None, 1, 1.0, MAY1)])
    spec = CONTRACTS["fact_user_food_feedback"]
    assert rows_of(quality.key_violations(fact, spec)) == [(spec.name, "1|1|2025-05-01", 2)]
    dim = table("dim_user", [(1, "m", 1990, 1, 1, "x"), (3, None, 1990, 1, 1, "x"), (4, "q", 1990, 1, 1, "x")])
    assert rows_of(quality.domain_violations(dim, "dim_user", "gender", ("m", "f"))) == [("dim_user", "gender", "q", 1)]
    assert rows_of(quality.orphan_keys(fact, dim, "f", "user_id")) == [("f", 2, 1)]
    report = {r.column_name: (r.is_key, r.null_count, r.row_count) for r in quality.contract_report(fact, spec).collect()}
    assert report["user_id"] == (True, 1, 4) and report["food_score"] == (False, 0, 4)
    empty = quality.contract_report(fact.limit(0), spec).collect()
    assert len(empty) == 4 and {r.row_count for r in empty} == {0}


def test_a_load_reads_only_its_dates(spark, table):
    name, root = "fact_user_food_feedback", scratch_path(spark, "warehouse")
    loads.store(table(name, [(1, 1, 2.0, MAY1), (1, 2, 3.0, MAY2)]), root, name)
    touched = loads._touched(loads.read_table(spark, root, name), table(name, [(9, 9, 1.0, MAY2)]), contract(name))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2025-05-02" in plan


def test_null_keys_are_refused_before_anything_is_written(spark, table, rows_of):
    name, root = "fact_user_food_feedback", scratch_path(spark, "warehouse")
    loads.store(table(name, [(1, 1, 2.0, MAY1)]), root, name)
    for strategy in loads.STRATEGIES:
        with pytest.raises(loads.NullKeyError):
            loads.store(table(name, [(2, 2, 1.0, None)]), root, name, strategy)
    assert rows_of(loads.read_table(spark, root, name)) == [(1, 1, 2.0, MAY1)]


def test_arrival_order_decides_among_repeats(spark, rows_of):
    name = "fact_user_food_feedback"
    batch = spark.createDataFrame([(2, 1, 1, 5.0, MAY1), (1, 1, 1, 9.0, MAY1)], "id long, user_id long, food_id long, food_score double, rating_date date")
    for strategy, score in (("ignore", 9.0), ("overwrite", 5.0)):
        root = scratch_path(spark, "warehouse")
        loads.store(batch, root, name, strategy, "id")
        assert rows_of(loads.read_table(spark, root, name)) == [(1, 1, score, MAY1)]


def test_a_repeat_in_the_target_is_not_the_batch_s_fault(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string")
    assert loads.load_append(target, spark.createDataFrame([(2, "c")], target.schema), ["id"]).count() == 3


def test_whole_table_overwrite(spark, table, rows_of):
    root, name = scratch_path(spark, "marts"), "dm_user_tag_stats"
    loads.replace_table(table(name, [(1, "a", 2), (2, "b", 1)]), root, name)
    loads.replace_table(table(name, [(1, "c", 3)]), root, name)
    assert rows_of(loads.read_table(spark, root, name)) == [(1, "c", 3)]
    with pytest.raises(ValueError, match="missing columns"):
        loads.replace_table(table(name, [(1, "d", 4)]).drop("tag"), root, name)
    with pytest.raises(ValueError, match="unknown table"):
        loads.replace_table(table(name, []), root, "elsewhere")
    assert rows_of(loads.read_table(spark, root, name)) == [(1, "c", 3)]
