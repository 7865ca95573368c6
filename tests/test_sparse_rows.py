import datetime as dt
import json
import pathlib
import random

import numpy as np
import pytest
from pyspark.ml.classification import FMClassifier
from pyspark.sql import functions as F

from mealmarts import registry
from mealmarts.plans import factor_machine, models, sparse_rows
from mealmarts.session import scratch_path
from mealmarts.sources import files

D1, D2 = dt.date(2025, 5, 1), dt.date(2025, 5, 2)
SCHEMA = (
    "review_id long, user_id long, date date, menu_id_a long, menu_id_b long, label int, gender string, region string, "
    "class_num string, avg_food_score_a double, avg_food_score_b double"
)
ROWS = [
    (1, 10, D1, 11, 12, 0, "m", "Seoul", "1", 3.25, None),
    (2, 9, D1, 11, 12, 1, None, "Busan", "10", 3.25, None),
    (3, 10, D2, 21, 22, 1, "m", "Seoul", "1", 0.0, 4.0),
]
LINKS = [(11, 1), (11, 2), (12, 3), (21, 3), (22, 4)]
FOODS = [(1, "spicy"), (2, "spicy"), (3, "sweet"), (4, None)]


@pytest.fixture(scope="module")
def inputs(spark):
    links = spark.createDataFrame(LINKS, "menu_id long, food_id long")
    foods = spark.createDataFrame(FOODS, "food_id long, tag string")
    return spark.createDataFrame(ROWS, SCHEMA), sparse_rows.tag_vectors(links, foods)


FEATURES = [
    "user_id=9", "user_id=10", "gender=m", "region=Busan", "region=Seoul", "class_num=1", "class_num=10",
    "tag_a_spicy", "tag_a_sweet", "tag_b_sweet", "avg_food_score_a", "avg_food_score_b",
]


def test_dictionary_order(inputs):
    entries = {r.idx: r.feature for r in sparse_rows.feature_dictionary(*inputs).collect()}
    assert [entries[i] for i in range(len(FEATURES))] == FEATURES and len(entries) == len(FEATURES)


@pytest.fixture(params=["10485760", "-1"])
def broadcast_bound(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines(inputs, broadcast_bound):
    """Real values for numbers; nulls and zeros left out; the same without broadcast lookups."""
    encoded = sparse_rows.entries(*inputs, sparse_rows.feature_dictionary(*inputs))
    lines = {r.review_id: r.line for r in sparse_rows.libfm_lines(inputs[0], *encoded).collect()}
    assert lines == {
        1: "0 1:1 2:1 4:1 5:1 7:2 9:1 10:3.25",
        2: "1 0:1 3:1 6:1 7:2 9:1 10:3.25",
        3: "1 1:1 2:1 4:1 5:1 8:1 11:4",
    }


def test_no_rows_give_no_lines(inputs, spark):
    from mealmarts.session import scratch_path
    from mealmarts.sources.files import write_lines

    none = inputs[0].limit(0)
    encoded = sparse_rows.entries(none, inputs[1], sparse_rows.feature_dictionary(none, inputs[1]))
    path = scratch_path(spark, "lines")
    write_lines(sparse_rows.libfm_lines(none, *encoded), path)
    assert spark.read.text(path).count() == 0


def test_fm_trains_and_scores_by_review(inputs):
    dictionary = sparse_rows.feature_dictionary(*inputs)
    rows = sparse_rows.sparse_rows(inputs[0], *sparse_rows.entries(*inputs, dictionary))
    assert rows.count() == len(ROWS)
    model = models.train_fm(rows, len(FEATURES), maxIter=3)
    assert model.factors.numCols == 8 and model.factors.numRows == len(FEATURES)
    scored = {r.review_id: r for r in models.predict_fm(model, rows, len(FEATURES)).collect()}
    assert set(scored) == {1, 2, 3}
    assert all(r.predicted == int(r.score >= 0.5) for r in scored.values())


def test_json_columns(spark, rows_of):
    df = spark.createDataFrame([(1, '{"a": 1, "b": 2.5}'), (2, "{}"), (3, None), (4, "broken")], "id int, j string")
    assert rows_of(sparse_rows.json_features(df, "id", "j")) == [(1, "a", 1.0), (1, "b", 2.5)]
    wide = sparse_rows.json_feature_columns(df, "j", ["a", "c"]).drop("j")
    assert rows_of(wide) == [(1, 1.0, None), (2, None, None), (3, None, None), (4, None, None)]


def test_mixed_json_loses_only_what_is_no_number(spark, rows_of):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x", "c": {"d": 2, "e": {"f": 3.5}, "g": [4]}, "h": true, "i": null}')], "id int, j string")
    assert rows_of(sparse_rows.json_features(df, "id", "j")) == [(1, "a", 1.0), (1, "c.d", 2.0), (1, "c.e.f", 3.5)]
    wide = sparse_rows.json_feature_columns(df, "j", ["a", "b", "c.d", "c.e.f"]).drop("j")
    assert rows_of(wide) == [(1, 1.0, None, 2.0, 3.5)]


def flat(value, name=""):
    """Plain flatten: numbers, also as text, of nested objects."""
    for key, item in value.items():
        path = f"{name}.{key}" if name else key
        if isinstance(item, dict):
            yield from flat(item, path)
        elif not isinstance(item, bool) and isinstance(item, (int, float, str)):
            try:
                yield path, float(item)
            except ValueError:
                pass


def test_objects_of_any_depth(spark, rows_of):
    rng = random.Random(2)

    def made(depth):
        kinds = [1, 2.5, -3e20, "7", "word", True, None, [1, {"a": 2}], "", 0]
        out = {f"k{i}": rng.choice(kinds) for i in range(rng.randint(0, 4))}
        if depth:
            out |= {f"o{i}": made(depth - 1) for i in range(rng.randint(0, 2))} | {"deep": made(depth - 1)}
        return out

    rows = [(i, made(i % 7)) for i in range(40)] + [(99, {"a": {"b": {"c": {"d": {"e": {"f": 6, "g.h": 7}}}}}})]
    df = spark.createDataFrame([(i, json.dumps(o)) for i, o in rows], "id int, j string")
    want = sorted(((i, n, x) for i, o in rows for n, x in flat(o)), key=repr)
    assert rows_of(sparse_rows.json_features(df, "id", "j")) == want and any(n.count(".") > 5 for _, n, _ in want)
    names = ["a.b.c.d.e.f", "a.b.c.d.e.g.h", "deep.deep.deep.k0", "deep.deep.deep.deep.deep.k0"]
    found = {(i, n): x for i, n, x in want}
    wide = sparse_rows.json_feature_columns(df, "j", names).drop("j")
    assert rows_of(wide) == sorted((tuple([i, *[found.get((i, n)) for n in names]]) for i, _ in rows), key=repr)


def test_a_dictionary_grows_at_its_end(spark, inputs, rows_of):
    root = scratch_path(spark, "dictionary")
    comparison, vectors = inputs
    first = {r.feature: r.idx for r in sparse_rows.extend_dictionary(comparison.filter("review_id = 3"), vectors, root).collect()}
    for _ in range(2):
        whole = sparse_rows.extend_dictionary(comparison, vectors, root)
        after = {r.feature: r.idx for r in whole.collect()}
        assert {f: after[f] for f in first} == first and 0 < len(first) < len(after)
        assert sorted(after.values()) == list(range(len(after))) and set(after) == {r.feature for r in sparse_rows.feature_dictionary(*inputs).collect()}
    rows = sparse_rows.sparse_rows(comparison, *sparse_rows.entries(comparison, vectors, whole)).collect()
    assert all([f.idx for f in r.features] == sorted(f.idx for f in r.features) for r in rows)
    plain = sparse_rows.sparse_rows(comparison, *sparse_rows.entries(*inputs, sparse_rows.feature_dictionary(*inputs)))
    assert {r.review_id: len(r.features) for r in rows} == {r.review_id: len(r.features) for r in plain.collect()}


def test_a_dictionary_of_some_rows_scores_all(inputs):
    some = inputs[0].filter("review_id = 1")
    dictionary = sparse_rows.feature_dictionary(some, inputs[1])
    rows = sparse_rows.sparse_rows(inputs[0], *sparse_rows.entries(*inputs, dictionary))
    assert rows.count() == len(ROWS) and models.fit_sample(rows, 10).count() == len(ROWS)
    vectors = models.sparse_vectors(rows, dictionary.count())
    assert {v.features.size for v in vectors.collect()} == {dictionary.count()}
    plan = vectors._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fm_queries_fit_on_all_rows(spark, inputs, monkeypatch):
    """Every comparison row is fitted on and every user known, however few rows a trial fit would take."""
    rows = [(i, i % 25, D1 if i % 3 else D2, 11, 12, i % 2, "m", "Seoul", "1", 3.25, None) for i in range(50)]
    tables = registry.Tables(spark, "")
    monkeypatch.setattr(tables, "fm_inputs", lambda: (spark.createDataFrame(rows, SCHEMA), inputs[1]))
    trial, train, fitted = models.fit_sample, models.train_fm, []
    monkeypatch.setattr(models, "fit_sample", lambda rows, limit=5: trial(rows, limit))

    def trained(rows, size):
        fitted.append((rows.agg(F.sum("rows")).first()[0], size))
        return train(rows, size, maxIter=2)

    monkeypatch.setattr(models, "train_fm", trained)
    assert tables.fm_predictions().count() == 50
    assert fitted == [(50, sparse_rows.feature_dictionary(*tables.fm_inputs()).count())] and fitted[0][1] > 25


@pytest.fixture
def some_rows(spark):
    """Rows of 12 users, one of them in half of the rows, with codes that others share and counts by date."""
    rng = random.Random(5)
    days = [[(f, float(rng.randint(1, 3))) for f in rng.sample(range(16, 24), 4)] + [(24, rng.uniform(1, 5))] for _ in range(6)]
    rows = []
    for i in range(120):
        user, day = rng.choice([3, rng.randrange(12)]), rng.randrange(6)
        entries = sorted([(user, 1.0), (12 + user % 3, 1.0), *days[day]] + [(15, 1.0)] * (user != 4))
        rows.append((i, user, D1 + dt.timedelta(days=day), int(rng.random() < 0.3 + user % 3 / 5), entries))
    schema = "review_id long, user_id long, date date, label int, features array<struct<idx:bigint,value:double>>"
    return spark.createDataFrame(rows, schema), rows


def test_fm_steps_are_those_of_pyspark_ml(some_rows):
    """Linear weights and intercept, as only the start of the factors differs."""
    df, _ = some_rows
    vectors = models.sparse_vectors(df, 25).withColumn("label", F.col("label").cast("double"))
    want = FMClassifier(**{**models.FM_PARAMS, "initStd": 1e-12}).fit(vectors)
    got = models.train_fm(df, 25, initStd=1e-12)
    assert got.linear.toArray() == pytest.approx(want.linear.toArray(), abs=1e-9) and abs(got.linear.toArray()).max() > 0.01
    assert got.intercept == pytest.approx(want.intercept, abs=1e-9) and abs(got.factors.toArray()).max() < 1e-10


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "5")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("entries", [60, 4_000_000])
def test_fm_steps_and_scores_whatever_the_blocks(spark, some_rows, small_batches, monkeypatch, entries):
    """The same weights and scores as of plain arrays, with users and codes in one block or in several."""
    monkeypatch.setattr(factor_machine, "BLOCK_ENTRIES", entries)
    df, rows = some_rows
    x, y = np.zeros((len(rows), 25)), np.array([r[3] for r in rows])
    for i, row in enumerate(rows):
        for f, value in row[4]:
            x[i, f] = value
    w, (v, b) = np.zeros(25), (factor_machine._start(np.arange(25), 8, 0.3, 7)[1:].T, 0.0)

    def share():
        return 1 / (1 + np.exp(-(b + x @ w + ((x @ v) ** 2 - x**2 @ v**2).sum(axis=1) / 2)))

    for i in range(1, 13):
        off, rate = share() - y, 0.05 / i**0.5 / len(rows)
        step = x.T @ (off[:, None] * (x @ v)) - v * (x**2 * off[:, None]).sum(axis=0)[:, None]
        w, v, b = w - rate * (x.T @ off), v - rate * step, b - rate * off.sum()
    packed = models.packed_rows(df, 25)
    assert packed.count() > 8 or entries > 60
    model = models.train_fm(packed, 25, maxIter=12, stepSize=0.05, initStd=0.3)
    assert model.factors.toArray() == pytest.approx(v, abs=1e-9) and model.linear.toArray() == pytest.approx(w, abs=1e-9)
    scored = {r.review_id: (r.label, r.score) for r in models.predict_fm(model, df, 25).collect()}
    assert [scored[i][0] for i in range(len(rows))] == y.tolist() and len(scored) == len(rows)
    assert [scored[i][1] for i in range(len(rows))] == pytest.approx(share(), abs=1e-9)


def test_fm_of_large_counts_gives_shares(some_rows):
    """Steps that lose all measure are taken back: the model is no worse than the one it started from."""
    df, rows = some_rows
    large = df.withColumn("features", F.expr("transform(features, f -> struct(f.idx, if(f.idx > 15, f.value * 1000, f.value) AS value))"))
    scored = models.predict_fm(models.train_fm(large, 25), large, 25)
    assert scored.filter("score BETWEEN 0 AND 1").count() == len(rows)


def test_fm_of_no_rows_and_of_rows_without_features(spark, some_rows):
    df, _ = some_rows
    none = df.limit(0)
    assert models.predict_fm(models.train_fm(none, 25), none, 25).count() == 0
    bare = df.withColumn("features", F.expr("filter(features, f -> false)"))
    model = models.train_fm(bare, 25, maxIter=2)
    scores = [r.score for r in models.predict_fm(model, bare, 25).collect()]
    assert len(scores) == 120 and scores == pytest.approx([1 / (1 + np.exp(-model.intercept))] * 120)


def test_fm_metrics(spark):
    scored = spark.createDataFrame([(1, 0.5, 1), (1, 0.0, 0), (0, 1.0, 1), (0, 0.0, 0)], "label int, score double, predicted int")
    row = models.fm_metrics(scored).first()
    assert (row.precision, row.recall) == (0.5, 0.5) and row.rmse == pytest.approx(0.75)


def test_fm_fits_on_all_cores_whatever_the_files(spark):
    """Rows in one file, nine tenths of one user: no task of a fit has a large part of them."""
    rows = spark.range(4000, numPartitions=1).selectExpr(
        "id AS review_id", "IF(id % 10 = 0, id, 7L) AS user_id", "CAST(id % 2 AS DOUBLE) AS label"
    )
    spread = models.fit_partitions(rows)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert spread.rdd.getNumPartitions() == len(sizes) == cores and sum(sizes) == 4000
    assert max(sizes) < 2 * 4000 / cores


def test_packed_lines_come_back_and_files_stay_small(spark):
    """Packed lines take less room than their text; the number of files follows from the rows, not from the tasks."""
    path, lines = scratch_path(spark, "packed"), [f"{i % 2} {i}:1 9000{i % 7}:2 9001{i % 5}:3 9002{i % 3}:4" for i in range(1000)]
    files.write_lines(spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1), path, "line", "gzip", 300)
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(lines)
    stored = [p for p in pathlib.Path(path).iterdir() if p.name.startswith("part-")]
    assert len(stored) == 4 and sum(p.stat().st_size for p in stored) < sum(map(len, lines)) / 2
