"""Secret scans over an incremental blob ledger.

Every version of every text is addressed by its SHA-256. The ledger, a Parquet folder, holds
one row for each (blob, rule, rule version) that was ever scanned, with the spans found or an
empty list. A scan reads the ledger, takes the blobs and rules it lacks, scans each such blob
once however many paths hold it, appends the outcome, and joins the findings of the current
rule versions back to all paths. A rule that changes gets a new version and is the only one
to be scanned again.

Null text is the empty blob. Rows with the same or a null id are paths of their own. Spans count
code points, the end is exclusive. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from mealmarts.llm.common import map_batches, parts, text_key
from mealmarts.session import stage


class Rule(NamedTuple):
    """Leftmost non-overlapping matches, kept if ``group`` has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A whole key: all from its BEGIN line to its END line. Without an END line, what follows the BEGIN line and looks like
# a key: header lines, then base64 that is padded, in runs of 16 or more, or alone on its line and no plain word, then the
# short rest on a line of its own. Line breaks may be escaped. Possessive throughout, so the time is linear.
_BREAK, _RUN, _ALONE = r"""(?:\s|\\[nrt]|["'>])""", r"[A-Za-z0-9+/]", r"""(?=[^\S\n]*+(?:[\n"'`\\]|\Z))"""
_WORD = rf"(?:[A-Z]?[a-z]*+|[A-Z]++)(?!{_RUN})"
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
    r"(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
    rf"|(?:{_BREAK}++(?:Proc-Type|DEK-Info):[^\n\\]*+)*+"
    rf"(?:(?:{_BREAK}*+(?:{_RUN}{{16,}}+={{0,2}}+|{_RUN}++={{1,2}}+|(?!{_WORD}){_RUN}++{_ALONE}))++(?:{_BREAK}++{_RUN}++{_ALONE})?+)?+)"
)
RULES = (
    Rule("assign", 1, ASSIGN, re.IGNORECASE | re.ASCII, 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", 1, r"[0-9a-f]{16,}"),  # a run of 16 or more is one match of the run
    Rule("private_key", 2, PRIVATE_KEY),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("host_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", 1, r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("map_key", 1, r"AIza[A-Za-z0-9_-]{35}"),
)
LEDGER = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def matches(rule: Rule, text: str) -> list[tuple[int, int]]:
    return [
        m.span() for m in re.compile(rule.pattern, rule.flags).finditer(text) if len(m.group(rule.group)) >= rule.least
    ]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """What has been scanned so far; empty where there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LEDGER)
        raise


def _scanner(rules: Sequence[Rule]):
    def run(batch: pa.RecordBatch):
        for part in parts(batch, "text"):
            blobs, kinds, versions, spans = [], [], [], []
            for blob, todo, text in zip(*(part.column(c).to_pylist() for c in ("blob", "todo", "text"))):
                for rule in (rules[i] for i in todo):
                    blobs.append(blob)
                    kinds.append(rule.kind)
                    versions.append(rule.version)
                    spans.append([{"start": a, "end": b} for a, b in matches(rule, text)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(blobs, pa.binary()), pa.array(kinds), pa.array(versions, pa.int32()), pa.array(spans, _SPANS)],
                names=["blob", "rule", "version", "spans"],
            )

    return run


def update_ledger(docs: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> None:
    """Scan the (blob, rule version) pairs that the ledger lacks, and append them.

    The pairs that are left are worked out on hashes alone, before any text moves: where nothing is new, none does,
    and while the new blobs are few enough for Spark to broadcast their hashes, known texts stay where they are.
    Copies of a blob meet as one text in every task before the shuffle. A run that dies before its commit leaves
    the ledger as it was.
    """
    spark = docs.sparkSession
    seen = (
        read_ledger(spark, path)
        .groupBy("blob")
        .agg(F.collect_set(F.struct("rule", "version")).alias("seen"))  # as many as there are rule versions
    )
    pairs = F.coalesce("seen", F.array().cast("array<struct<rule:string,version:int>>"))
    missing = [~F.array_contains(pairs, F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"))) for r in rules]
    todo = F.array_compact(F.array(*[F.when(m, F.lit(i)) for i, m in enumerate(missing)]))  # places in ``rules``
    held = docs.select(text_key().alias("blob")).distinct()
    unseen = stage(held.join(seen, "blob", "left").select("blob", todo.alias("todo")).filter(F.size("todo") > 0), "unseen")
    if unseen.isEmpty():
        return
    texts = docs.select(text_key().alias("blob"), "text")
    if not read_ledger(spark, path).isEmpty():
        texts = texts.join(unseen.select("blob"), "blob", "left_semi")
    blobs = texts.groupBy("blob").agg(F.any_value(F.coalesce("text", F.lit(""))).alias("text"))
    scanned = blobs.join(unseen, "blob").select("blob", "todo", "text")
    map_batches(scanned, _scanner(rules), LEDGER).write.mode("append").parquet(path)


def findings(docs: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, blob and ``spans`` array<struct<start, end, place, kind>> in order, for every path.

    ``place`` is the kind's place in ``rules``. Paths and findings meet on the blob; the findings are
    one short row per blob that has any, staged, so a blob with very many paths can be split.
    """
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r.kind, r.version, i) for i, r in enumerate(rules)], "rule string, version int, place int")
    found = stage(
        read_ledger(spark, path)
        .filter(F.size("spans") > 0)
        .join(F.broadcast(wanted), ["rule", "version"])  # a row per rule
        .select("blob", F.explode(F.array_distinct("spans")).alias("s"), "place", F.col("rule").alias("kind"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("s.start", "place", "s.end", "kind"))).alias("spans")),
        "findings",
    )
    none = F.array().cast(found.schema["spans"].dataType)
    paths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("blob"))
    return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def _line(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(found: DataFrame, base: Sequence[str] = ("assign", "access", "hex")) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""

    def of(kind: str):
        return F.filter("spans", lambda s: s["kind"] == kind)

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(_line(F.filter("spans", lambda s: s["kind"].isin(*base))).cast("binary"), 256).alias("base_sha256"),
        _line("spans").alias("spans"),
    )


def redact(docs: DataFrame, path: str, rules: Sequence[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span (overlaps as one) replaced by ``mark``; all columns stay.

    Only texts with a finding change. The findings meet the rows on the blob, as in ``findings``.
    """
    found = stage(
        findings(docs, path, rules).filter(F.size("spans") > 0).groupBy("blob").agg(F.any_value("spans").alias("spans")),
        "redactions",
    ).select("blob", F.transform("spans", lambda s: F.struct(s["start"], s["end"])).alias("spans"))
    # All columns of ``docs`` travel inside one, so none of them can clash with the join's own.
    rows = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("row"), text_key().alias("blob"))
    text = F.col("row.text")

    def put(done, s):
        fresh = F.concat(done["out"], F.substr(text, done["at"] + 1, s["start"] - done["at"]), F.lit(mark))
        return F.struct(
            F.when(s["start"] >= done["at"], fresh).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], s["end"]).alias("at"),
        )

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate("spans", begin, put, lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1)))
    clean = F.when(F.col("spans").isNull(), text).otherwise(cut)
    joined = rows.join(found, "blob", "left").withColumn("clean", clean)
    return joined.select(*[F.col("clean").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
