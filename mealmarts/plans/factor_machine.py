"""Factorization machine over all rows and features: packed rows, full-batch gradient descent, scores.

The steps are those of ``pyspark.ml``'s FMClassifier with the solver ``gd``, which keeps all weights in the driver and
in every task. Here rows lie in blocks of ranges of users. Weights of features that only one block has (those of nearly
all users) stay with the block; the others (codes, tags, mean scores, a user whose rows two blocks share) are few, and
they alone are summed in the driver and sent to the tasks.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.session import shared_dir, ship, stage

# Entries of sparse rows in a block, about; bounds what a task holds at once.
BLOCK_ENTRIES = 4_000_000
# Steps after which a lost block starts again from stored weights.
CHECKPOINT_EVERY = 10


@dataclass
class FactorModel:
    """``weights`` has a row per feature that occurred: ``idx`` and its linear weight followed by its factors."""

    intercept: float
    weights: DataFrame
    size: int
    factor_size: int

    def _collected(self) -> np.ndarray:
        found = np.zeros((self.size, 1 + self.factor_size))
        for row in self.weights.toLocalIterator():
            found[row.idx] = row.weights
        return found

    @property
    def factors(self) -> DenseMatrix:
        """In the driver, for a look at a small model; features that never occurred have zeros."""
        return DenseMatrix(self.size, self.factor_size, self._collected()[:, 1:].ravel("F"))

    @property
    def linear(self) -> DenseVector:
        return DenseVector(self._collected()[:, 0])


# --- packed rows -------------------------------------------------------------------------


def _dumped(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _loaded(data: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(data)))


def _runs(row: np.ndarray, pos: np.ndarray, val: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` rows, whether its entries equal those of the row before."""
    length = np.bincount(row, minlength=n)
    same = np.r_[False, length[1:] == length[:-1]] if n else np.zeros(0, bool)
    before = np.maximum(np.arange(len(row)) - length[row], 0)
    return same & (np.bincount(row, (pos != pos[before]) | (val != val[before]), n) == 0)


def _block(rows: pa.RecordBatch) -> tuple[np.ndarray, bytes]:
    """Feature indexes of some rows, and the rows as parts: what all rows of a date have, and what is left of a row.

    A row's entries are those of its two parts. Rows that follow each other with the same rest, as a user's do, share it.
    """
    n = len(rows)
    lists = rows.column("indices")
    idx, val = lists.flatten().to_numpy(), rows.column("values").flatten().to_numpy()
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    day = rows.column("date").dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
    known, pos = np.unique(idx, return_inverse=True)
    keys, first, of, times = np.unique(day[row] * len(known) + pos, return_index=True, return_inverse=True, return_counts=True)
    common = (times == np.bincount(day)[keys // max(len(known), 1)]) & (np.bincount(of, val != val[first][of], len(keys)) == 0)
    rest = ~common[of]
    row, rest_pos, rest_val = row[rest], pos[rest], val[rest]
    same = _runs(row, rest_pos, rest_val, n)
    person, kept, persons = np.cumsum(~same) - 1, ~same[row], n - int(same.sum())
    day_keys = keys[common]
    return known, _dumped(
        label=rows.column("label").to_numpy().astype(np.int8),
        person=person.astype(np.int32),
        day=(persons + day).astype(np.int32),
        part=np.r_[person[row[kept]], persons + day_keys // max(len(known), 1)].astype(np.int32),
        pos=np.r_[rest_pos[kept], day_keys % max(len(known), 1)].astype(np.int32),
        val=np.r_[rest_val[kept], val[first][common]],
    )


def _cell(values: pa.Array) -> pa.Array:
    """One list cell that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def packed(rows: DataFrame) -> DataFrame:
    """Rows with ML vectors as staged blocks, in the order and the partitions they come in."""
    ship(rows.sparkSession)
    plain = rows.select("review_id", F.col("label").cast("int").alias("label"), "date", F.unwrap_udt("features").alias("features"))
    plain = plain.select("review_id", "label", "date", "features.indices", "features.values")
    most, key = BLOCK_ENTRIES, rows.schema["review_id"].dataType.simpleString()
    names = ["block", "rows", "review_id", "label", "known", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries, made = [], 0, TaskContext.get().partitionId() << 32

        def block():
            whole = pa.concat_batches(held)
            known, data = _block(whole)
            ids, labels = _cell(whole.column("review_id")), _cell(whole.column("label"))
            return pa.RecordBatch.from_arrays([pa.array([made]), pa.array([len(whole)]), ids, labels, _cell(pa.array(known)), pa.array([data])], names)

        for batch in batches:
            if len(batch):
                held.append(batch)
                entries += len(batch.column("indices").flatten())
            if entries >= most:
                yield block()
                held, entries, made = [], 0, made + 1
        if held:
            yield block()

    schema = f"block long, rows long, review_id array<{key}>, label array<int>, known array<int>, data binary"
    return stage(plain.mapInArrow(run, schema), "packed-rows")


# --- arithmetic of a block ---------------------------------------------------------------
# Weights have a column per feature: the linear weight, then the factors.


def _forward(block: dict[str, np.ndarray], weights: np.ndarray, intercept: float) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores, and the sums of weighted factors per row they come from."""
    person, day, part, parts = block["person"], block["day"], block["part"], int(block["day"].max()) + 1
    sums, squares = np.empty((len(weights), parts)), np.zeros(len(part))
    for j, column in enumerate(weights):
        entries = column[block["pos"]] * block["val"]
        sums[j] = np.bincount(part, entries, parts)
        if j:
            squares += entries**2
    sums[0] -= np.bincount(part, squares, parts) / 2
    raw, factors = intercept + sums[0][person] + sums[0][day], np.empty((len(weights) - 1, len(person)))
    for j, column in enumerate(sums[1:]):
        factors[j] = column[person] + column[day]
        raw += factors[j] ** 2 / 2
    return raw, factors


def _share(raw: np.ndarray) -> np.ndarray:
    """Logistic function, without overflow."""
    return (1 + np.tanh(raw / 2)) / 2


def _gradient(block: dict[str, np.ndarray], weights: np.ndarray, intercept: float) -> tuple[np.ndarray, float, float]:
    """Sums over the block's rows: gradient of the logistic loss by feature and by the intercept, and the loss."""
    raw, factors = _forward(block, weights, intercept)
    part, pos, val, parts = block["part"], block["pos"], block["val"], int(block["day"].max()) + 1
    off, gradient = _share(raw) - block["label"], np.empty_like(weights)
    for j, column in enumerate(weights):
        by_row = off * factors[j - 1] if j else off
        by_part = np.bincount(block["person"], by_row, parts) + np.bincount(block["day"], by_row, parts)
        by_entry = by_part[part] * val
        if j:
            by_entry -= column[pos] * own_squares
        else:
            own_squares = by_entry * val
        gradient[j] = np.bincount(pos, by_entry, len(column))
    return gradient, float(off.sum()), float(np.logaddexp(0, np.where(block["label"] > 0, -raw, raw)).sum())


def _start(idx: np.ndarray, factor_size: int, std: float, seed: int) -> np.ndarray:
    """Linear weights 0 and normal factors, which follow from the seed and the feature's index alone."""
    mixed = np.asarray(idx, np.uint64) * np.uint64(2 * factor_size) + np.arange(2 * factor_size, dtype=np.uint64)[:, None]
    mixed += np.uint64((seed << 40) + 0x9E3779B97F4A7C15)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(times)
    even = ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    normal = np.sqrt(-2 * np.log(even[:factor_size])) * np.cos(2 * np.pi * even[factor_size:])
    return np.vstack([np.zeros(even.shape[1]), std * normal])


# --- fit and scores ----------------------------------------------------------------------


def fit(
    blocks: DataFrame,
    size: int,
    *,
    factorSize: int,
    maxIter: int,
    stepSize: float,
    seed: int,
    fitIntercept: bool = True,
    fitLinear: bool = True,
    solver: str = "gd",
    initStd: float = 0.01,
    tol: float = 1e-6,
) -> FactorModel:
    """A model of all packed rows. The parameters have the names, meanings and defaults of ``pyspark.ml``.

    A step after which the loss is greater than at the start, or no number, is taken back, and it and all further steps
    are a tenth as long: counts in the hundreds would else give weights without bound, and scores that are no number.
    """
    if solver != "gd":
        raise ValueError(f"unknown solver: {solver}")
    spark = blocks.sparkSession
    ship(spark)
    shared_dir(spark)
    total = blocks.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    features = blocks.select(F.explode("known").alias("idx")).groupBy("idx").agg(F.count("*").alias("n"))
    common = np.sort(np.array([r.idx for r in features.filter("n > 1").toLocalIterator()], np.int64))
    shared, intercept = _start(common, factorSize, initStd, seed), 0.0

    def started(row):
        known, block = np.array(row.known, np.int64), _loaded(row.data)
        place = np.searchsorted(common, known)
        is_shared = np.r_[common, -1][place] == known
        block |= {"shared_at": np.flatnonzero(is_shared), "shared_place": place[is_shared], "own_at": np.flatnonzero(~is_shared)}
        idx = known[~is_shared]
        return idx, block, _start(idx, factorSize, initStd, seed), None

    def stepped(sent, rate):
        def step(state):
            idx, block, own, _ = state
            shared, intercept = sent.value
            codes = {k: v.astype(np.intp) for k, v in block.items() if k in ("person", "day", "part", "pos")}
            weights = np.empty((1 + factorSize, len(block["own_at"]) + len(block["shared_at"])))
            weights[:, block["own_at"]], weights[:, block["shared_at"]] = own, shared[:, block["shared_place"]]
            with np.errstate(all="ignore"):  # the loss tells
                gradient, by_intercept, loss = _gradient(block | codes, weights, intercept)
                if not fitLinear:
                    gradient[0] = 0
                moved = rate * gradient[:, block["own_at"]]
                own = own - moved
                by_shared = np.zeros_like(shared)
                by_shared[:, block["shared_place"]] = gradient[:, block["shared_at"]]
                return idx, block, own, (by_shared, by_intercept, loss, float((moved**2).sum()), float((own**2).sum()))

        return step

    def passed(state, rate, kept):
        """The state after a step, and the sums over all blocks."""
        sent = spark.sparkContext.broadcast((shared, intercept))
        after = state.map(stepped(sent, rate)).persist(StorageLevel.MEMORY_AND_DISK)
        if kept:
            after.checkpoint()
        return after, after.map(lambda s: s[3]).reduce(lambda a, b: tuple(x + y for x, y in zip(a, b)))

    state = blocks.select("known", "data").rdd.map(started).persist(StorageLevel.MEMORY_AND_DISK)
    i, length, first, before, ended = 1, 1.0, None, None, False
    while total:
        rate = length * stepSize / i**0.5 / total
        after, (by_shared, by_intercept, loss, moved, norm) = passed(state, rate, i % CHECKPOINT_EVERY == 0)
        first = loss if first is None else first
        if before and np.isfinite(first) and not loss <= first * (1 + 1e-9):
            after.unpersist()
            state.unpersist()
            state, shared, intercept, i = before
            before, length, ended = None, length / 10, False
            continue
        if ended or i > maxIter:  # this pass was for the loss alone
            after.unpersist()
            break
        if before:
            before[0].unpersist()
        before = state, shared, intercept, i
        step, back = rate * by_shared, rate * by_intercept * fitIntercept
        state, shared, intercept = after, shared - step, intercept - back
        moved, norm = moved + (step**2).sum() + back**2, norm + (shared**2).sum() + intercept**2
        ended = i > 1 and moved**0.5 < tol * max(norm**0.5, 1.0)
        i += 1
    rows = state.map(lambda s: (s[0].tobytes(), s[2].T.tobytes()))
    both = spark.createDataFrame(rows, "idx binary, weights binary").unionByName(
        spark.createDataFrame([(common.tobytes(), shared.T.tobytes())], "idx binary, weights binary")
    )

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for idx, weights in zip(batch.column("idx"), batch.column("weights")):
                idx, flat = pa.array(np.frombuffer(idx.as_py(), np.int64)), pa.array(np.frombuffer(weights.as_py()))
                ends = pa.array(np.arange(len(idx) + 1, dtype=np.int32) * (1 + factorSize), pa.int32())
                yield pa.RecordBatch.from_pydict({"idx": idx, "weights": pa.ListArray.from_arrays(ends, flat)})

    weights = stage(both.mapInArrow(unpacked, "idx long, weights array<double>"), "fm-weights")
    for held in filter(None, (state, before and before[0])):
        held.unpersist()
    return FactorModel(float(intercept), weights, size, factorSize)


def scores(model: FactorModel, blocks: DataFrame) -> DataFrame:
    """``review_id, label, score`` of all packed rows; a feature that the model does not know adds nothing."""
    ship(blocks.sparkSession)
    width, intercept = 1 + model.factor_size, model.intercept
    none = F.array_repeat(F.lit(0.0), width)
    found = (
        blocks.select("block", F.explode("known").alias("idx"))
        .join(model.weights, "idx", "left")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("idx", F.coalesce("weights", none).alias("weights")))).alias("found"))
    )
    met = blocks.join(found, "block", "left").select("review_id", "label", "data", F.flatten(F.col("found.weights")).alias("weights"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, labels, data, weights = (batch.column(c)[i] for c in ("review_id", "label", "data", "weights"))
                flat = weights.values.to_numpy() if weights.is_valid else np.zeros(0)
                raw, _ = _forward(_loaded(data.as_py()), flat.reshape(-1, width).T, intercept)
                yield pa.RecordBatch.from_pydict({"review_id": ids.values, "label": labels.values, "score": pa.array(_share(raw))})

    key = blocks.schema["review_id"].dataType.elementType.simpleString()
    return met.mapInArrow(run, f"review_id {key}, label int, score double")
