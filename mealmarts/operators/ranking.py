"""Top-n per group, one row per key, and dense numbering of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mealmarts.session import stage

# monotonically_increasing_id keeps the row's place inside its task in the low 33 bits.
_PLACE_BITS = (1 << 33) - 1


def top_n(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], n: int, name: str) -> DataFrame:
    """First ``n`` rows per group, numbered in ``name``.

    The filter on the rank makes Spark keep ``n`` rows per group and task before the
    shuffle, so a group of any size costs the receiving task only ``n`` rows per sender.
    """
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order."""
    return top_n(df, keys, order_by, 1, "_place").drop("_place")


def greatest_row(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key the row that is greatest in ``columns``, compared left to right, null lowest.

    An aggregate: copies of a key shrink to one row in each task, without a window.
    """
    row = F.max(F.struct(*columns)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str,
    partition_by: Sequence[str] = (),
    start: int = 1,
) -> DataFrame:
    """``row_number`` over groups too large for one task.

    Rows are range-partitioned and sorted on group and order, so one group spreads over
    many tasks. A row's number is its place in its task plus the rows of its group in
    earlier tasks. The placed rows are staged because both steps must see the same range
    bounds, also when a lost task runs again. ``order_by`` must end in a unique key.
    """
    order = [F.col(c) for c in partition_by] + list(order_by)
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS))),
        "placed",
    )
    keys = [*partition_by, "_task"]
    earlier = Window.partitionBy(*partition_by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task, plus one per further group that starts inside a task. Staged, so
    # that Spark knows its size when it picks the join.
    offsets = stage(
        placed.groupBy(*keys)
        .agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first"))
        .select(*keys, "_before"),
        "offsets",
    )
    number = F.col("_before") + F.col("_place") + F.lit(start)
    return placed.join(offsets, keys).withColumn(name, number).drop("_task", "_place", "_before")
