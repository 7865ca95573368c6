"""Stored states that a periodic run extends: each must equal a build of everything, and read little."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from mealmarts.operators import loads
from mealmarts.plans import month_chain, monthly_marts, rank_state, score_sketches, user_marts
from mealmarts.session import scratch_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- months ------------------------------------------------------------------------------


@pytest.fixture
def meals(table):
    """Reviews and votes of six months; none in the fourth."""
    rng, day = random.Random(3), dt.date(2025, 1, 1)
    menus = [(m, dt.date(2025, 1 + m % 6, 1 + m % 28)) for m in range(1, 40) if 1 + m % 6 != 4]
    times = [d for d in (day + dt.timedelta(days=rng.randint(0, 180)) for _ in range(150)) if d.month != 4]
    reviews = [(i, rng.randint(1, 20), 1, 3.0, 0, None, dt.datetime.combine(d, dt.time(12))) for i, d in enumerate(times)]
    votes = [(i, rng.choice(menus)[0], rng.randint(15, 40)) for i in range(80)]
    return table("menu_review", reviews), table("pre_vote", votes), table("menu", menus)


def test_chain_equals_the_series_with_late_rows(spark, meals, rows_of):
    reviews, votes, menu = meals
    root = scratch_path(spark, "chain")
    month_chain.start_chain(reviews, votes, menu, root, "2025-02")
    for month in ("2025-02", "2025-03", "2025-04", "2025-05", "2025-06"):
        some = reviews.filter("id % 3 = 0") if month in ("2025-02", "2025-05") else reviews
        month_chain.extend_chain(some, votes, menu, root, month)
    for month in ("2025-05", "2025-02", "2025-02"):
        month_chain.extend_chain(reviews, votes, menu, root, month)
    want = monthly_marts.monthly_count_series(reviews, votes, menu)
    got = month_chain.stored_months(spark, root)
    assert rows_of(got) == rows_of(want) and "2025-04" not in {r.month for r in got.collect()}


def test_chain_without_a_start_and_a_month_that_lost_its_rows(spark, meals, rows_of):
    reviews, votes, menu = meals
    root, none = scratch_path(spark, "chain"), votes.limit(0)
    assert rows_of(month_chain.stored_months(spark, root)) == []
    month_chain.extend_chain(reviews, none, menu, root, "2025-02")
    (first,) = month_chain.stored_months(spark, root).collect()
    assert first.evaluator == first.cumulative == first.difference > 0
    month_chain.extend_chain(reviews, none, menu, root, "2025-03")
    month_chain.extend_chain(reviews.limit(0), none, menu, root, "2025-02")
    second = reviews.filter("month(timestamp) = 3").count()
    assert rows_of(month_chain.stored_months(spark, root)) == [("2025-02", 0, 0, 0), ("2025-03", second, second, second)]


def test_chain_reads_one_month_and_one_stored_row(spark, meals):
    reviews, votes, menu = meals
    root, path = scratch_path(spark, "chain"), scratch_path(spark, "reviews")
    reviews.write.parquet(path)
    month_chain.start_chain(reviews, votes, menu, root, "2025-06")
    own, before, later = month_chain.chain_inputs(spark.read.parquet(path), votes, menu, root, "2025-06")
    assert "timestamp#" in plan_of(own) and ">= 2025-06-01 00:00:00" in plan_of(own) and "< 2025-07-01 00:00:00" in plan_of(own)
    assert "PartitionFilters" in plan_of(before) and "2025-05-01" in plan_of(before) and "2025-03-01" not in plan_of(before)
    assert before.count() == 1 and later.isEmpty()


def test_running_distinct_evaluators(table, rows_of, meals):
    reviews, votes, menu = meals
    reviews = reviews.unionByName(
        table("menu_review", [(900, None, 1, 1.0, 0, None, dt.datetime(2024, 12, 1)), (901, 1, 1, 1.0, 0, None, None)])
    )
    dated = {r.menu_id: r.date for r in menu.collect()}
    seen = [(r.timestamp.strftime("%Y-%m"), r.user_id) for r in reviews.collect() if r.timestamp]
    seen += [(dated[r.menu_id].strftime("%Y-%m"), r.user_id) for r in votes.collect()]
    want, last = [], 0
    for month in sorted({m for m, _ in seen}):
        people = len({u for m, u in seen if m <= month and u is not None})
        want.append((month, people - last, people))
        last = people
    assert rows_of(monthly_marts.running_distinct_evaluators(reviews, votes, menu)) == want and want[0] == ("2024-12", 0, 0)


# --- rankings ----------------------------------------------------------------------------


@pytest.fixture
def facts(table):
    rng = random.Random(4)
    rows = {
        (rng.randint(1, 12), rng.randint(1, 9), dt.date(2025, 5, rng.randint(1, 8))): rng.choice([None, 0.5, 1.0, 2.5, 5.0])
        for _ in range(260)
    }
    return table("fact_user_food_feedback", [(u, f, s, d) for (u, f, d), s in rows.items()])


@pytest.fixture
def names(spark):
    return spark.createDataFrame([(f, f"food{f}") for f in range(1, 9)], "food_id long, food_name string")


def test_ranks_by_days_late_repeated_and_corrected(spark, facts, names, rows_of):
    root = scratch_path(spark, "ranks")
    day, part = F.col("rating_date"), {d: facts.filter(F.col("rating_date") == F.lit(d).cast("date")) for d in (f"2025-05-0{i}" for i in range(1, 9))}
    known = facts.filter(day <= F.lit("2025-05-04").cast("date"))
    rank_state.start_ranks(known, root, "2025-05-04")
    for d in ("2025-05-05", "2025-05-07", "2025-05-07", "2025-05-06", "2025-05-08"):
        known = known.unionByName(part[d]).distinct()
        rank_state.add_day(part[d], root, d, known)
        want = user_marts.user_food_rating_rank(known, names)
        assert rows_of(rank_state.stored_ranks(spark, root, names)) == rows_of(want)
    corrected = facts.withColumn("food_score", F.when(day == F.lit("2025-05-06").cast("date"), 5.0).otherwise(F.col("food_score")))
    rank_state.add_day(corrected.filter(day == F.lit("2025-05-06").cast("date")), root, "2025-05-06", corrected)
    assert rows_of(rank_state.stored_ranks(spark, root, names)) == rows_of(user_marts.user_food_rating_rank(corrected, names))
    before = rows_of(loads.read_table(spark, root, rank_state.SUMS))
    rank_state.add_day(facts.limit(0), root, "2025-05-09", facts)
    assert rows_of(loads.read_table(spark, root, rank_state.SUMS)) == before


def test_a_day_touches_only_its_users(spark, facts, rows_of):
    root = scratch_path(spark, "ranks")
    rank_state.start_ranks(facts, root, "2025-05-08")
    one = facts.filter("user_id = 3").limit(1).withColumn("rating_date", F.lit("2025-05-09").cast("date"))
    (bucket,) = [r.bucket for r in one.select(rank_state._bucket()).collect()]
    plan = plan_of(rank_state.touched_parts(spark, root, rank_state.SUMS, [bucket]))
    assert "PartitionFilters" in plan and "bucket#" in plan and str(bucket) in plan
    others = rows_of(loads.read_table(spark, root, rank_state.SUMS).filter(F.col("user_id") != 3).drop("as_of"))
    rank_state.add_day(one, root, "2025-05-09", facts.unionByName(one))
    after = loads.read_table(spark, root, rank_state.SUMS)
    assert rows_of(after.filter(F.col("user_id") != 3).drop("as_of")) == others
    assert {str(r.as_of) for r in after.filter(F.col("bucket") != bucket).select("as_of").collect()} == {"2025-05-08"}


def files_of(root, table):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(root, table).glob("bucket=*/*.parquet")}


def bucket_users(spark, bucket):
    ids = spark.range(1500).withColumnRenamed("id", "user_id").filter(rank_state._bucket() == bucket)
    return sorted(r.user_id for r in ids.collect())


@pytest.fixture
def crowd(spark, table):
    """Three dishes each of all users of two partitions."""
    users = bucket_users(spark, 5) + bucket_users(spark, 6)
    return table("fact_user_food_feedback", [(u, f, (u * f) % 10 / 2, dt.date(2025, 5, 1)) for u in users for f in (1, 2, 3 + u % 6)])


def test_a_day_leaves_the_large_partitions_until_enough_changed(spark, table, crowd, names, rows_of):
    root, users = scratch_path(spark, "ranks"), bucket_users(spark, 5)
    rank_state.start_ranks(crowd, root, "2025-05-01")
    large = files_of(root, rank_state.SUMS) | files_of(root, rank_state.LISTS)
    known = crowd

    def load(day, some):
        nonlocal known
        batch = table("fact_user_food_feedback", [(u, f, 4.5, dt.date(2025, 5, day)) for u in some for f in (1, 8)])
        known = known.unionByName(batch)
        rank_state.add_day(batch, root, f"2025-05-0{day}", known)
        want = user_marts.user_food_rating_rank(known, names)
        assert rows_of(rank_state.stored_ranks(spark, root, names)) == rows_of(want)
        return files_of(root, rank_state.SUMS) | files_of(root, rank_state.LISTS)

    one = [users[0]]  # four rows at most, of 3 * len(users)
    assert len(users) * 3 > 4 * rank_state.FOLD and load(3, one) == large and load(2, one) == large  # the second comes late
    folded = load(4, users)
    changed = {path for path in large.keys() | folded.keys() if large.get(path) != folded.get(path)}
    assert changed and all("bucket=5/" in path for path in changed)
    assert not any(files_of(root, recent) for recent in rank_state.RECENT.values())
    sums = rows_of(loads.read_table(spark, root, rank_state.SUMS).filter("bucket = 5"), "user_id", "food_id", "total", "n")
    want = known.filter(F.col("user_id").isin(users)).groupBy("user_id", "food_id").agg(F.sum("food_score"), F.count("*"))
    assert sums == rows_of(want)


def test_a_broken_fold_and_a_new_start(spark, table, crowd, names, rows_of, monkeypatch):
    root, users = scratch_path(spark, "ranks"), bucket_users(spark, 5)
    rank_state.start_ranks(crowd, root, "2025-05-01")
    days = [table("fact_user_food_feedback", [(u, 8, 5.0, dt.date(2025, 5, d)) for u in users[d:]]) for d in (2, 3)]
    monkeypatch.setattr(rank_state, "drop_parts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    known = crowd.unionByName(days[0])
    with pytest.raises(RuntimeError):
        rank_state.add_day(days[0], root, "2025-05-02", known)
    monkeypatch.undo()
    assert all(files_of(root, recent) for recent in rank_state.RECENT.values())
    assert rows_of(rank_state.stored_ranks(spark, root, names)) == rows_of(user_marts.user_food_rating_rank(known, names))
    known = known.unionByName(days[1])
    rank_state.add_day(days[1], root, "2025-05-03", known)
    assert rows_of(rank_state.stored_ranks(spark, root, names)) == rows_of(user_marts.user_food_rating_rank(known, names))
    few = table("fact_user_food_feedback", [(users[0], 8, 1.0, dt.date(2025, 5, 4))])
    rank_state.add_day(few, root, "2025-05-04", known.unionByName(few))
    assert files_of(root, rank_state.RECENT[rank_state.LISTS])
    rank_state.start_ranks(crowd, root, "2025-05-01")
    assert rows_of(rank_state.stored_ranks(spark, root, names)) == rows_of(user_marts.user_food_rating_rank(crowd, names))


# --- sketches ----------------------------------------------------------------------------


def test_merged_quartiles_are_within_their_error(spark, table, rows_of):
    rng = random.Random(6)
    rows = [
        (i, 1, 1, None if i % 50 == 0 else rng.lognormvariate(0, 1 + i % 3), dt.datetime(2025, 1 + i % 3, 1 + i % 27, i % 24))
        for i in range(30_000)
    ]
    reviews, root = table("food_review", rows), scratch_path(spark, "sketches")
    score_sketches.store_sketches(reviews.filter("id < 20000"), root)
    score_sketches.store_sketches(reviews.filter("month(timestamp) = 1"), root)  # those days come again, whole
    score_sketches.store_sketches(reviews.filter("month(timestamp) > 1"), root)
    checked = score_sketches.within_error(score_sketches.stored_quartiles(spark, root), reviews).collect()
    assert len(checked) == 3 and all(r.q1_within and r.q3_within for r in checked)
    assert sum(r.n for r in checked) == sum(r[3] is not None for r in rows)
    assert loads.read_table(spark, root, score_sketches.TABLE).count() == 27
    wrong = score_sketches.stored_quartiles(spark, root).withColumn("q1", F.col("q1") * 1.5)
    assert not any(r.q1_within for r in score_sketches.within_error(wrong, reviews).collect())


# --- dated loads -------------------------------------------------------------------------

NAME = "raw_user_insight"
MAY1, MAY2 = dt.date(2025, 5, 1), dt.date(2025, 5, 2)


def test_a_load_sent_twice_is_stored_once(spark, table, rows_of):
    root, rows = scratch_path(spark, "insights"), [(1, MAY1, "a"), (2, MAY2, "b")]
    assert rows_of(loads.read_loads(spark, root, NAME)) == []
    assert loads.append_once(table(NAME, rows), root, NAME, "one")
    assert not loads.append_once(table(NAME, rows[::-1]), root, NAME, "one")
    assert loads.append_once(table(NAME, [(3, MAY2, "c")]), root, NAME, "two")
    assert rows_of(loads.read_loads(spark, root, NAME)) == [(1, MAY1, "a"), (2, MAY2, "b"), (3, MAY2, "c")]
    with pytest.raises(loads.ChangedBatchError):
        loads.append_once(table(NAME, [(1, MAY1, "other"), (2, MAY2, "b")]), root, NAME, "one")
    with pytest.raises(loads.DuplicateKeyError):
        loads.append_once(table(NAME, [(3, MAY2, "again")]), root, NAME, "three")
    with pytest.raises(loads.NullKeyError):
        loads.append_once(table(NAME, [(None, MAY2, "x")]), root, NAME, "four")
    assert loads.append_once(table(NAME, []), root, NAME, "empty")
    assert len(rows_of(loads.read_loads(spark, root, NAME))) == 3


def test_a_broken_load_leaves_nothing_twice(spark, table, rows_of, monkeypatch):
    """The run breaks off between rows and ledger; a retry has other dates."""
    root = scratch_path(spark, "insights")
    whole = loads.replace_parts
    monkeypatch.setattr(loads, "replace_parts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        loads.append_once(table(NAME, [(1, MAY1, "a"), (2, MAY2, "b")]), root, NAME, "one")
    monkeypatch.setattr(loads, "replace_parts", whole)
    assert rows_of(loads.read_loads(spark, root, NAME)) == []
    assert loads.append_once(table(NAME, [(1, MAY1, "a")]), root, NAME, "one")
    assert rows_of(loads.read_loads(spark, root, NAME)) == [(1, MAY1, "a")]


def test_recent_reviews(table, rows_of):
    at = dt.datetime(2025, 5, 31, 12)
    rows = [(i, u, 1, 1.0, 0, None, at - dt.timedelta(days=d, hours=h)) for i, (u, d, h) in enumerate([(1, 0, 0), (1, 30, 0), (1, 30, 1), (2, 400, 0)])]
    assert rows_of(user_marts.recent_reviews(table("menu_review", rows), 30)) == [
        (1, at - dt.timedelta(days=30), 2), (2, at - dt.timedelta(days=430), 1)
    ]
