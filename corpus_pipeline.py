"""Training corpus in five stages: quality, near-duplicates, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. The first four
return the columns of documents. A row without doc_id, or with one that other rows have too, is judged under a
number of its own, made from its id, text, language and source; so verdicts meet the row they are about. Rows equal in
these four are one document: all go or stay, and the near-duplicate stage leaves one of them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mealmarts.llm import bpe, decontamination, near_duplicates, quality, secrets
from mealmarts.llm.common import ship
from mealmarts.llm.queries import RANKS
from mealmarts.session import scratch_path, stage

NEAR = 80  # percent of shingles shared by near-duplicates


def _numbered(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with two further columns, and their names: the number a row is judged by, and whether it was made up.

    Made-up numbers are 61 bits of a hash above 2^62, so that documents with an id come first in their group.
    """
    row, made = "_row", "_made"
    while {row, made} & set(docs.columns):
        row, made = f"{row}_", f"{made}_"
    own = docs.withColumn(row, F.col("doc_id").cast("long"))
    often = own.filter(F.col(row).isNotNull()).groupBy(row).count().filter("count > 1")
    flagged = own.join(stage(often.select(row), "repeated_ids").withColumn(made, F.lit(True)), row, "left")
    flagged = flagged.withColumn(made, F.col(row).isNull() | F.col(made).isNotNull())
    number = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "text", "lang", "source"), 3)
    return flagged.withColumn(row, F.when(F.col(made), number).otherwise(F.col(row))), row, made


def _without(docs: DataFrame, name: str, rejected: Callable[[DataFrame], DataFrame], once: bool = False) -> DataFrame:
    """``docs`` without the rows that ``rejected`` names by doc_id; equal rows ``once`` if asked.

    Numbers alone are staged, so their size is known.
    """
    numbered, row, made = _numbered(docs)
    gone = stage(rejected(numbered.withColumn("doc_id", F.col(row))).select(F.col("doc_id").alias(row)).distinct(), name)
    kept = numbered.join(gone, row, "left_anti")
    if once:  # only rows with made-up numbers can be equal, only they are grouped
        kept = kept.filter(~F.col(made)).unionByName(kept.filter(made).dropDuplicates([row]))
    return kept.select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return _without(docs, "rejected", lambda rows: quality.judge(quality.statistics(rows)).filter("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Links from a similarity of 0.8 of the shingles; 0.85 is the contract of ``op7`` alone."""
    return _without(docs, "duplicates", lambda rows: near_duplicates.near_duplicates(rows, NEAR).filter("not kept"), True)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, "leaked", lambda rows: decontamination.leaks(rows, items))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts, which changes n_chars with them."""
    ledger = scratch_path(spark, "pipeline_ledger")
    secrets.update_ledger(docs, ledger)
    clean = secrets.redact(docs, ledger)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the digests of ids and decoded bytes, which equal those of the text."""
    decoded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    return bpe.digests(decoded)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", benchmark_leaks),
    ("secret scan", secret_scan),
    ("token ids", token_ids),
]

#: Robust estimates, sketches and merges by rank have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
