"""Quality rules: robust multivariate outliers per language and source.

Every text is described by statistics of its words and lines. A base rule rejects texts that
are too short or mostly repeat themselves. The rest are judged by a vector of transformed
statistics: shares by the arcsine of their root, lengths by their logarithm. For each (language,
source) the minimum covariance determinant estimate of centre and scatter is taken over all its
documents: the ``CORE`` share of rows whose covariance has the least determinant. A document is
rejected if its squared Mahalanobis distance from that estimate exceeds ``CUTOFF``.

The estimate is found by concentration steps from two starts that need no random subset (medians
with scaled deviations; plain moments). One step is one aggregate over the staged vectors: rows are
counted and their moments summed per group, start and bin of the distance, so a group of any size
comes to a few thousand sums; the bins below the core's quantile give the next estimate. Steps go on for the
groups and starts whose determinant still falls by more than ``FALL`` of itself, so they end by themselves. The start
with the smaller determinant wins. Shares that are zero in nearly all texts would make the
determinant zero, so every scatter gets ``FLOOR`` squared on its diagonal (the regularised form).

In a group without scatter or shares of its own a floor alone says what one feature has to reach to reject a text: a share of
0.17 of symbols, 0.28 of bare words or of capitals, 0.75 of repeated lines, 0.48 of repeated words (the base rule takes over at
0.5), or words 2.3 times as long.

A group with fewer than ``LEAST`` rows takes the estimate of its language, that of all documents
after that; with fewer rows than ``LEAST`` in all there is none and the base rule alone decides.

Null or empty texts have no words and fail the base rule. Null languages or sources are groups of
their own. Repeated rows and ties are rows like any other. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mealmarts.llm.common import map_batches
from mealmarts.session import stage

COLUMNS = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_letters n_upper n_bare".split()
FEATURES = ("symbols", "bare_words", "upper", "dup_lines", "repeats", "word_length")
FLOOR = (0.06, 0.08, 0.08, 0.15, 0.11, 0.12)
CORE, LEAST, FALL = 0.75, 100, 1e-6
CUTOFF = 48.0  # about the 1 - 1e-8 quantile of chi-square with six degrees
_BINS = 24  # per doubling of 1 + squared distance
_P = len(FEATURES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_SYMBOLS = b"#*$%&|<>"


def repeated_words(tokens: list[bytes], width: int = 3) -> int:
    """Words in ``width``-word windows that occur twice or more in the text, the first included."""
    n = len(tokens) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in tokens), np.int64, len(tokens))
    code = ids[:n]
    for i in range(1, width):  # renumbered, so the product fits for any text
        pair = code * np.int64(len(numbers)) + ids[i : i + n]
        code, count = np.unique(pair, return_inverse=True, return_counts=True)[1:]
    mark = np.zeros(len(tokens) + 1, np.int64)
    again = np.flatnonzero(count[code] > 1)
    mark[again] += 1
    mark[again + width] -= 1
    return int((np.cumsum(mark[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The columns after doc_id, for one whole text."""
    raw = text.encode() if text else b""
    tokens = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    white = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    code_points = len(text) if text else 0
    plain = np.frombuffer(raw, np.uint8)
    upper = int(((plain >= 65) & (plain <= 90)).sum())
    lower = int(((plain >= 97) & (plain <= 122)).sum())
    beyond = int((plain >= 0xC0).sum())  # first bytes of longer characters
    symbols = sum(map(raw.count, (bytes([c]) for c in _SYMBOLS)))
    bare = sum(1 for w in tokens if len(w) < 4 and not w.isalnum() and not any(c > 127 or chr(c).isalnum() for c in w))
    return (
        len(tokens), code_points - white, symbols, len(lines) - len(set(lines)), repeated_words(tokens),
        len(lines), upper + lower + beyond, upper, bare,
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every text, one row each."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = list(zip(*map(text_counts, batch.column(3).to_pylist())))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *[pa.array(r, pa.int64()) for r in rows]], names=["doc_id", "lang", "source", *COLUMNS[1:]]
        )

    kept = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), "text",
    )
    return map_batches(kept, run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COLUMNS[1:]))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics, in the order of ``FEATURES``."""

    def share(part: str, whole: str) -> Column:
        ratio = F.col(part) / F.greatest(F.col(whole), F.lit(1))
        return F.asin(F.sqrt(F.least(ratio, F.lit(1.0))))

    return [
        share("n_symbols", "word_chars"),
        share("n_bare", "n_words"),
        share("n_upper", "n_letters"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)) + 1e-9),
    ]


def _chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(degrees // 2):
        total += term
        term *= half / (k + 1)
    return 1 - math.exp(-half) * total


def consistency(core: float = CORE, degrees: int = _P) -> float:
    """What the core's covariance is multiplied by to estimate that of normal data."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi_square(mid, degrees) < core else (low, mid)
    return core / _chi_square(low, degrees + 2)


_ESTIMATE = "g string, start int, n long, det double, centre array<double>, inverse array<double>"


def _estimate(count: float, sums: np.ndarray, products: np.ndarray, scale: float) -> tuple[float, list, list]:
    centre = sums / count
    scatter = np.zeros((_P, _P))
    for (i, j), total in zip(_PAIRS, products):
        scatter[i, j] = scatter[j, i] = total / count - centre[i] * centre[j]
    scatter = scatter * scale + np.diag(np.square(FLOOR))
    # Rounded, so that the order in which sums arrive cannot change a verdict.
    inverse = np.linalg.inv(scatter)
    return float(np.linalg.det(scatter)), [float(f"{v:.9g}") for v in centre], [float(f"{v:.9g}") for v in inverse.ravel()]


def _moments() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.array(*[F.sum(f"v{i}") for i in range(_P)]).alias("sums"),
        F.array(*[F.sum(F.col(f"v{i}") * F.col(f"v{j}")) for i, j in _PAIRS]).alias("products"),
    ]


def _distance() -> Column:
    d = [F.col(f"v{i}") - F.col("centre")[i] for i in range(_P)]
    terms = [d[i] * d[j] * F.col("inverse")[i * _P + j] * (1 if i == j else 2) for i, j in _PAIRS]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _starts(rows: DataFrame) -> DataFrame:
    medians = [F.percentile_approx(f"v{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(_P)]
    table = rows.groupBy("g").agg(*_moments(), *medians)

    def run(frames):
        for frame in frames:
            out = []
            for r in frame.itertuples():
                quartiles = np.array([getattr(r, f"q{i}") for i in range(_P)])
                spread = np.square((quartiles[:, 2] - quartiles[:, 0]) / 1.349) + np.square(FLOOR)
                out.append((r.g, 0, r.n, float(np.prod(spread)), quartiles[:, 1].tolist(), np.diag(1 / spread).ravel().tolist()))
                out.append((r.g, 1, r.n, *_estimate(r.n, np.array(r.sums), np.array(r.products), 1.0)))
            yield pd.DataFrame(out, columns=["g", "start", "n", "det", "centre", "inverse"])

    return stage(table.mapInPandas(run, _ESTIMATE), "mcd_start")


def _step(rows: DataFrame, estimates: DataFrame, core: float) -> DataFrame:
    bins = (
        rows.join(estimates.select("g", "start", "centre", "inverse"), "g")
        .withColumn("bin", F.floor(F.log2(1 + _distance()) * _BINS).cast("int"))
        .groupBy("g", "start", "bin")
        .agg(*_moments())
    )
    scale = consistency(core)

    def concentrate(frame: pd.DataFrame) -> pd.DataFrame:  # one row per bin
        frame = frame.sort_values("bin")
        below = np.cumsum(frame["n"].to_numpy())
        last = int(np.searchsorted(below, math.ceil(core * below[-1])))
        frame = frame.iloc[: last + 1]
        made = _estimate(below[last], np.sum(frame["sums"].to_list(), axis=0), np.sum(frame["products"].to_list(), axis=0), scale)
        return pd.DataFrame([(frame["g"].iloc[0], frame["start"].iloc[0], below[-1], *made)], columns=["g", "start", "n", "det", "centre", "inverse"])

    return stage(bins.groupBy("g", "start").applyInPandas(concentrate, _ESTIMATE), "mcd_step")


def estimates(rows: DataFrame, core: float = CORE, least: int = LEAST) -> DataFrame:
    """(g, n rows, det, centre, inverse) of the groups ``g`` of ``rows`` (g, v0..) with ``least`` rows or more."""
    sizes = rows.groupBy("g").count().filter(F.col("count") >= least)
    rows = rows.join(stage(sizes, "mcd_groups").select("g"), "g")
    # The starts are no core's estimates, so the first step's determinants are the first to compare.
    falling = _step(rows, _starts(rows), core)
    settled = falling.limit(0)
    while not falling.isEmpty():
        before = falling.select("g", "start", F.struct("n", "det", "centre", "inverse").alias("old"))
        made = stage(_step(rows, falling, core).join(before, ["g", "start"]), "mcd_compared")
        falls = F.col("det") < F.col("old.det") * (1 - FALL)
        settled = settled.unionByName(made.filter(~falls).select("g", "start", "old.*"))
        falling = made.filter(falls).drop("old")
    best = F.min_by(F.struct("n", "det", "centre", "inverse"), F.struct("det", "start"))
    return stage(settled.groupBy("g").agg(best.alias("b")).select("g", "b.*"), "mcd")


def judge(stats: DataFrame, core: float = CORE, cutoff: float = CUTOFF, least: int = LEAST) -> DataFrame:
    """``stats`` with base_failed, distance (null without an estimate) and kept."""
    name = {
        "pair": F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"}),
        "lang": F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}),
        "all": F.lit("all"),
    }
    table = stats.withColumn("base_failed", base_failed()).select(
        "*", *[v.alias(f"v{i}") for i, v in enumerate(vector())], *[c.alias(f"g_{k}") for k, c in name.items()]
    )
    table = stage(table, "statistics")
    fit = table.filter("not base_failed")
    # A row counts in its pair, its language and the whole.
    groups = F.explode(F.array(*[f"g_{k}" for k in name])).alias("g")
    found = estimates(fit.select(groups, *[f"v{i}" for i in range(_P)]), core, least)
    # Which estimate a pair uses is settled on the pairs, a row each.
    pairs = fit.select(*[f"g_{k}" for k in name]).distinct()
    for k in name:
        own = found.select(F.col("g").alias(f"g_{k}"), F.struct("centre", "inverse").alias(f"e_{k}"))
        pairs = pairs.join(own, f"g_{k}", "left")
    chosen = stage(pairs.select("g_pair", F.coalesce(*[f"e_{k}" for k in name]).alias("e")).select("g_pair", "e.*"), "chosen")
    return (
        table.join(chosen, "g_pair", "left")
        .withColumn("distance", F.when(F.col("centre").isNotNull() & ~F.col("base_failed"), _distance()))
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))
        .drop("centre", "inverse", *[f"g_{k}" for k in name], *[f"v{i}" for i in range(_P)])
    )
