import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mealmarts.operators import fingerprints as P

SCHEMA = "id long, name string, x double, at timestamp_ntz, tags array<float>, s struct<a:int>"


@pytest.fixture(scope="module")
def source(spark):
    rng = random.Random(1)
    rows = [
        (i, rng.choice(["a", None, "", "ü"]), rng.choice([None, rng.uniform(-9, 9), 1e300, 0.1]), dt.datetime(2025, 5, 1, 2, 3, 4, i), [0.5, None], (i,))
        for i in range(500)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def changes(source, target, keys=("id",), bits=P.BITS):
    rows = P.differing_keys(source, target, list(keys), bits).collect()
    return sorted((r[0], r.change, tuple(r.columns)) for r in rows)


def test_equal_tables_in_any_order(source, rows_of):
    copy = source.repartition(7).orderBy(F.rand(1))
    assert P.same_rows(source, copy).first().same_rows
    assert changes(source, copy) == []
    assert rows_of(P.column_fingerprints(source, "t")) == rows_of(P.column_fingerprints(copy, "t"))


@pytest.mark.parametrize("bits", [2, P.BITS])
def test_one_changed_value_and_one_null_are_found(source, bits):
    wrong = source.withColumns(
        {
            "x": F.when(F.col("id") == 17, F.lit(0.1000001)).otherwise(F.col("x")),
            "at": F.when(F.col("id") == 400, F.lit(None)).otherwise(F.col("at")),
        }
    )
    assert not P.same_rows(source, wrong).first().same_rows
    assert changes(source, wrong, bits=bits) == [(17, "changed", ("x",)), (400, "changed", ("at",))]
    before, after = (
        {r.column_name: (r.row_count, r.null_count, r.fingerprint) for r in P.column_fingerprints(d, "t").collect()} for d in (source, wrong)
    )
    assert {c for c in before if before[c] != after[c]} == {"x", "at"}


def test_lost_new_and_repeated_rows(spark, source):
    target = source.filter("id <> 3").unionByName(source.filter("id in (5, 6)"))
    target = target.unionByName(source.filter("id = 9").withColumn("id", F.lit(9000).cast("long")))
    assert changes(source, target) == [(3, "missing", ()), (5, "repeated", ()), (6, "repeated", ()), (9000, "extra", ())]


def test_a_value_that_moves_between_columns(spark):
    schema = "id long, a long, b long"
    left, right = spark.createDataFrame([(1, None, 7), (None, 1, 1)], schema), spark.createDataFrame([(1, 7, None), (None, 1, 2)], schema)
    found = {r.id: tuple(r["columns"]) for r in P.differing_keys(left, right, ["id"]).collect()}
    assert found == {1: ("a", "b"), None: ("b",)}


def test_empty_tables(source):
    none = source.limit(0)
    assert P.same_rows(none, none).first().same_rows and changes(none, none) == []
    assert {(r.row_count, r.null_count, int(r.fingerprint)) for r in P.column_fingerprints(none, "t").collect()} == {(0, 0, 0)}
    assert len(changes(source, none)) == 500


def test_sums_of_hashes_take_no_decimal_per_row(spark):
    """Sums far beyond 64 bits are exact, with a decimal for the two halves only."""
    numbers = [2**63 - 1] * 5 + [-(2**63)] * 2 + [-1, 0, 1, 2**32, -(2**32) - 7, None]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    assert df.agg(P._exact_sum(F.col("n")).alias("s")).first().s == sum(n for n in numbers if n is not None)
    assert df.filter("n IS NULL").agg(P._exact_sum(F.col("n")).alias("s")).first().s == 0
    for frame in (P.column_fingerprints(df, "t"), P.row_sums(df)):
        scanned = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "sum(cast(" not in scanned and "sum((" in scanned
