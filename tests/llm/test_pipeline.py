"""The stages and the whole, on given documents and on odd ones."""

import random

import pytest

import corpus_pipeline
from mealmarts.llm import decontamination, near_duplicates, quality, queries, secrets
from mealmarts.llm.common import words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, step in corpus_pipeline.STAGES:
        out.append(step(spark, out[-1], FOLDER).cache())
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_each_stage_does_what_its_operator_says(spark, stages):
    docs, clean, single, tested, safe, _ = stages
    assert all(s.columns == docs.columns for s in stages[1:5])
    assert ids(clean) == ids(quality.judge(quality.statistics(docs)).filter("kept"))
    assert ids(single) == ids(near_duplicates.near_duplicates(clean, corpus_pipeline.NEAR).filter("kept"))
    items = [decontamination.shingles(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaky = {
        r.doc_id for r in single.collect()
        if any(i and len(i & decontamination.shingles(r.text)) >= 0.8 * len(i) for i in items)
    }
    assert ids(tested) == ids(single) - leaky and leaky
    for r in safe.collect():
        assert not any(secrets.matches(rule, r.text) for rule in secrets.RULES) and r.n_chars == len(r.text)


def test_run_equals_the_stages(spark, stages):
    rows = {tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert rows == {tuple(r) for r in stages[-1].collect()}
    assert rows == {tuple(r) for r in queries.QUERIES["pipeline"](spark, FOLDER).collect()}


def test_odd_documents_pass_through(spark, docs, odd_rows):
    frame = docs(odd_rows).selectExpr("*", "1 as kept", "2 as component_id", "3 as blob", "4 as distance")
    for rows in (frame, frame.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            made = step(spark, rows, FOLDER)
            assert made.count() <= rows.count(), name
    kept = corpus_pipeline.quality_rules(spark, frame, FOLDER)
    assert all(len(words(r.text)) >= 50 for r in kept.collect())


def test_rows_without_an_id_or_with_a_shared_one_are_judged_by_themselves(spark, docs):
    rng = random.Random(12)
    text = lambda n=120: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").filter("length(text) > 40").orderBy("item_id").first().text
    good, other, third, twice, leaky = text(), text(), text(), text(), f"{text()} {item} {text()}"
    rows = [
        (None, good), (None, "too short"), (None, leaky), (7, other), (7, "short too"), (7, f"{text()} {item}"), (8, third), (None, third),
        (9, twice), (9, twice), (None, good), (9, twice),
    ]
    frame = docs(rows)
    left = lambda step: sorted(((r.doc_id, r.text) for r in step(spark, frame, FOLDER).collect()), key=repr)
    want = lambda kept: sorted((r for r in rows if kept(r)), key=repr)
    assert left(corpus_pipeline.quality_rules) == want(lambda r: "short" not in r[1])
    assert left(corpus_pipeline.benchmark_leaks) == want(lambda r: item not in r[1])
    assert left(corpus_pipeline.near_dedup) == sorted(set(rows) - {(None, third)}, key=repr)


def test_near_duplicates_from_four_fifths_on_are_linked(spark, docs):
    """Pairs planted from 0.70 to 0.90, against brute force at 0.8."""
    rng, rows, want, between = random.Random(9), [], set(), 0
    for pair in range(60):
        base = [f"w{rng.randint(0, 9999)}" for _ in range(204)]  # 200 shingles
        copy = base[: 204 - (cut := rng.randint(10, 34))] + [f"e{rng.randint(0, 9999)}" for _ in range(cut)]
        a, b = ({tuple(t[i : i + 5]) for i in range(200)} for t in (base, copy))
        alike = len(a & b) / len(a | b)
        between += 0.8 <= alike < 0.85
        rows += [(2 * pair, " ".join(base)), (2 * pair + 1, " ".join(copy))]
        want |= {2 * pair} if alike >= 0.8 else {2 * pair, 2 * pair + 1}
    assert between > 5
    assert ids(corpus_pipeline.near_dedup(spark, docs(rows), FOLDER)) == want
