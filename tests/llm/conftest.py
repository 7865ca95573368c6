"""Small documents with what the operators must live through."""

import random

import pytest
from pyspark.sql import types as T

from mealmarts.llm.common import ship

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Frame of documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows):
        filled = [(*r, *("en", "s")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] else 0) for r in filled], SCHEMA)

    return make


def sentence(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, repeats, ties, a long text, and passages shared in whole and in part."""
    rng = random.Random(5)
    passage, other = sentence(rng, 60), sentence(rng, 45)
    base = sentence(rng, 120)
    words = base.split()
    edited = " ".join([*words[:50], "changed", *words[51:]])
    loop = "round and round it goes again " * 12
    rows = [
        (1, base), (2, base), (3, edited), (4, f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}"),
        (5, f"{sentence(rng, 10)} {passage}"), (6, f"{passage} {other}"), (7, f"x {other} {passage[:150]} y"),
        (8, None), (9, ""), (10, " \n\t "), (11, "one two three"), (12, "one two three"), (13, loop), (14, loop + "!"),
        (15, sentence(rng, 6000) + " " + passage), (16, "é" * 250 + " " + "ü" * 250), (17, "x" + "é" * 250), (None, base), (None, None),
        (18, sentence(rng, 19)), (19, passage), (19, passage), (20, "a" * 700),
    ]
    return rows
