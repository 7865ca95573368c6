"""Registered queries of the training-data operators: whole tables in, the agreed columns out."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mealmarts.llm import (
    alignment,
    bpe,
    compression,
    conversation_trie,
    decontamination,
    language,
    near_duplicates,
    phrases,
    quality,
    secrets,
    sharding,
    suffixes,
    token_files,
)
from mealmarts.llm.common import ship
from mealmarts.session import scratch_path, tune

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_PIECES = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID, SHARDS, QUALITY_SCORE = 2, 8, 0.7


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _held_out() -> Column:
    """A quarter of the documents; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op1_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(quality.statistics(documents(spark, folder)))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op2_language_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = language.train(docs.filter(F.coalesce(~_held_out(), F.lit(True))))
    return language.label(docs, model).withColumn("held_out", F.coalesce(_held_out(), F.lit(False)))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(documents(spark, folder), RANKS, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(encoded, RANKS, public_tokenizers.PATTERN))


def op4_best_fit_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.place(documents(spark, folder), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_suffix_sort(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.digests(suffixes.remove_repeats(documents(spark, folder)))


def op6_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    docs, ledger = documents(spark, folder), scratch_path(spark, "ledger")
    secrets.update_ledger(docs, ledger)
    return secrets.report(secrets.findings(docs, ledger))


def op7_chosen_path_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, folder), 85)


def op8_addressable_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    token_files.write(documents(spark, folder), path, WORD_PIECES, END_ID)
    return token_files.digests(token_files.read_documents(spark, path))


def op9_containment_search(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.leaks(documents(spark, folder), items)


def op10_repeated_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.digests(phrases.remove_repeats(documents(spark, folder)))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.numbered(spark.read.parquet(f"{folder}/conversations.parquet"))
    return conversation_trie.trie(*conversation_trie.rebuild(turns))


def op12_pair_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align(documents(spark, folder), BYTE_LEVEL, public_tokenizers.PATTERN, PIECES)
    return alignment.score(found, alignment.pair_counts(found))


def op13_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learned = docs.filter(~_held_out()), labels.filter(~_held_out())
    scored = compression.score(docs, compression.train(*learned))
    return scored.select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= QUALITY_SCORE, 1).otherwise(0).alias("predicted"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        tune(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f)
    for f in (
        op1_quality_outliers, op2_language_spans, op3_byte_bpe, op4_best_fit_shards, op5_suffix_sort,
        op6_secret_ledger, op7_chosen_path_join, op8_addressable_ids, op9_containment_search, op10_repeated_phrases,
        op11_conversation_trie, op12_pair_bitmaps, op13_compression_quality, pipeline,
    )
}

#: What DuckDB can express, by plain joins: shared shingles and the documents reachable over them; containment of benchmark items on
#: shingle texts; windows numbered by their first word; a trie whose nodes are lists of digests.
SQL: dict[str, str] = {
    "op7_chosen_path_join": r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
shingles as (
  select distinct doc_id, md5_number(array_to_string(w[i:i+4], ' ')) s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) i from words where len(w) > 0)),
sizes as (select doc_id, count(*) n from shingles group by 1),
shared as (select a.doc_id a, b.doc_id b, count(*) n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
edges as (select a, b from links union all select b, a from links),
reached as (select doc_id, doc_id as c from documents union select b, c from reached join edges on a = doc_id)
select doc_id, coalesce(any_value(n), 0) as n_shingles, min(c) as component_id, doc_id = min(c) as kept
from reached left join sizes using (doc_id) group by doc_id""",
    "op10_repeated_phrases": r"""
with words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
windows as (
  select doc_id, i, row_number() over (partition by s order by doc_id, i) as nth
  from (select doc_id, i, md5_number(array_to_string(w[i:i+19], ' ')) s
        from (select doc_id, w, unnest(range(1, len(w) - 18)) i from words where len(w) >= 20))),
taken as (select distinct doc_id, unnest(range(i, i + 20)) p from windows where nth > 1),
placed as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) p from words),
kept as (select doc_id, string_agg(word, ' ' order by p) t, count(*) n from placed anti join taken using (doc_id, p) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words left join kept using (doc_id)""",
    "op9_containment_search": r"""
with words as (
  select doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
item_words as (
  select item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') w from benchmark),
item_shingles as (
  select distinct item_id, array_to_string(w[i:i+4], ' ') s
  from (select item_id, w, unnest(range(1, len(w) - 3)) i from item_words)),
shingles as (
  select distinct doc_id, array_to_string(w[i:i+4], ' ') s from (select doc_id, w, unnest(range(1, len(w) - 3)) i from words)),
sizes as (select item_id, count(*) n from item_shingles group by 1),
shared as (select doc_id, item_id, count(*) n from shingles join item_shingles using (s) group by all)
select doc_id, item_id, shared.n as n_shared, sizes.n as n_item from shared join sizes using (item_id)
where shared.n >= 0.8 * sizes.n""",
    "op11_conversation_trie": r"""
with crc_table as (
  select list(list_reduce([b, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, x: xor(a >> 1, 3988292384 * (a & 1))) order by b) as t
  from (select unnest(range(256)) as b)),
turns as (
  select conv_id, d, n, row_number() over (partition by conv_id order by turn nulls first, d) as place
  from (select conv_id, turn, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as d,
               length(coalesce(text, '')) as n
        from conversations where conv_id is not null)),
convs as (
  select conv_id, conv_id - conv_id % 100 as base, n,
         xor(list_reduce([4294967295] || list_transform(range(1, length(s) + 1), lambda i: ascii(s[i:i])),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 as h
  from (select conv_id, cast(conv_id as varchar) as s, count(*) as n from turns group by conv_id), crc_table),
members as (
  select c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) as shared,
         least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) as n_turns
  from convs c left join convs b on b.conv_id = c.base),
sequences as (
  select m.conv_id, place as depth, d, t.n from members m join turns t on t.conv_id = m.base and place <= m.h
  union all
  select m.conv_id, place - m.h + m.shared, d, t.n from members m join turns t on t.conv_id = m.conv_id and place > m.h),
prefixes as (
  select conv_id, depth, n, list(d) over (partition by conv_id order by depth) as k from sequences
  union all select conv_id, 0, 0, [] from members),
nodes as (
  select p.depth, p.k, min(p.conv_id) as conv_id, count(*) as n_convs, any_value(p.n) as n,
         coalesce(string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id) filter (p.depth = n_turns), '') as ends
  from prefixes p join members using (conv_id) group by p.depth, p.k),
children as (select depth - 1 as depth, k[:-2] as k, count(*) as n_children from nodes where depth > 0 group by all),
weights as (
  select nodes.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * n as saved from nodes left join children using (depth, k)),
sums as (
  select p.depth, p.k, count(*) filter (w.n_children = 0) as n_leaves, cast(sum(w.saved) as bigint) as saved_tokens
  from weights w join prefixes p on p.conv_id = w.conv_id and p.depth <= w.depth group by p.depth, p.k)
select w.conv_id, w.depth, up.conv_id as parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(w.ends) as ends_sha256
from weights w join sums using (depth, k) left join nodes up on up.depth = w.depth - 1 and up.k = w.k[:-2]""",
}
