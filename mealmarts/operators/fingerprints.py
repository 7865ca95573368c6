"""Fingerprints of tables that do not depend on row order, and the keys in which two tables differ.

A column's fingerprint is the sum over its values of the first 60 bits of the MD5 of the value's text, so it can be
recomputed by any engine with MD5. Two tables with equal sums of row hashes hold the same rows as often. Where they
differ, ranges of key hashes are compared, then finer ranges inside those that differ, and only rows of
ranges left over are matched by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mealmarts.session import stage

BITS = 12  # of a key's hash, per step
_FRACTION = float(1 << 52)
_SUM = "decimal(38,0)"
_PART = 21  # bits of a hash that are added at a time


def _number_text(x: Column) -> Column:
    """Whole part and fraction in 2^-52, both exact; numbers too large for that as they print."""
    x = x.cast("double")
    parts = F.concat(F.floor(x).cast("string"), F.lit("+"), F.floor((x - F.floor(x)) * F.lit(_FRACTION)).cast("string"))
    return F.when(F.abs(x) < 1e15, parts).otherwise(x.cast("string"))


def value_text(value: Column, kind: T.DataType) -> Column:
    """A value as text that any engine can make; null stays null. Array entries are joined by a comma, null ones as ``null``."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _number_text(value)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.ArrayType):
        texts = F.transform(value, lambda e: F.coalesce(value_text(e, kind.elementType), F.lit("null")))
        return F.array_join(texts, ",")
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def _text_hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _exact_sum(number: Column) -> Column:
    """Sum of 64-bit numbers as ``_SUM``, 0 without any.

    Three parts of a number, 22 bits at most, are added as 64-bit numbers, which holds for 2^41 rows. Only their
    sums are made decimals, not every row.
    """
    low = F.lit((1 << _PART) - 1)
    parts = [number.bitwiseAND(low), F.shiftright(number, _PART).bitwiseAND(low), F.shiftright(number, 2 * _PART)]
    sums = [F.sum(part).cast("decimal(19,0)") * F.lit(1 << _PART * i).cast("decimal(13,0)") for i, part in enumerate(parts)]
    return F.coalesce((sums[0] + sums[1] + sums[2]).cast(_SUM), F.lit(0).cast(_SUM))


def column_fingerprints(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, row_count, null_count, fingerprint): one row per column, in one pass over the table."""
    sums = [F.count("*").alias("n")]
    for i, field in enumerate(df.schema):
        text = value_text(F.col(f"`{field.name}`"), field.dataType)
        sums += [F.count(text).alias(f"n{i}"), _exact_sum(_text_hash(text)).alias(f"s{i}")]
    columns = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            (F.col("n") - F.col(f"n{i}")).alias("null_count"),
            F.col(f"s{i}").alias("fingerprint"),
        )
        for i, field in enumerate(df.schema)
    ]
    rows = df.agg(*sums).select("n", F.explode(F.array(*columns)).alias("c"))
    return rows.select(F.lit(name).alias("table_name"), "c.column_name", F.col("n").alias("row_count"), "c.null_count", "c.fingerprint")


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row. Hashes pass over nulls, so each column's null mark goes in as well."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def row_sums(df: DataFrame) -> DataFrame:
    """One row (row_count, row_sum) that is equal for equal bags of rows."""
    return df.agg(F.count("*").alias("row_count"), _exact_sum(row_hash(df.columns)).alias("row_sum"))


def same_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row (same_rows): whether both hold the same rows as often, columns taken in the source's order."""
    both = row_sums(source).unionByName(row_sums(target.select(*source.columns)))
    return both.agg(((F.min("row_count") == F.max("row_count")) & (F.min("row_sum") == F.max("row_sum"))).alias("same_rows"))


def _differing_ranges(source: DataFrame, target: DataFrame, shift: int) -> DataFrame:
    """Ranges of key hashes, cut ``shift`` bits above the last, whose rows differ."""
    marked = source.select("_key", "_row", F.lit(1).alias("side")).unionByName(target.select("_key", "_row", F.lit(-1).alias("side")))
    signed = F.col("_row").cast(_SUM) * F.col("side")
    sums = marked.groupBy(F.shiftright("_key", shift).alias("_range")).agg(F.sum("side").alias("n"), F.sum(signed.cast(_SUM)).alias("s"))
    return stage(sums.filter("n <> 0 or s <> 0").select("_range"), "differing-ranges")


def differing_keys(source: DataFrame, target: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """(keys, change, columns): ``missing`` in the target, ``extra`` there, ``changed`` in the named columns, or ``repeated``.

    ``repeated``: a key that one side holds several times, and not the same rows on both. Two scans per side: the first for
    coarse ranges, the second for finer ones inside those that differ, whose rows alone are then shuffled by key.
    """
    columns = source.columns
    sides = [
        df.select(*columns).withColumns({"_row": row_hash(columns), "_key": row_hash(keys)}) for df in (source, target)
    ]
    for step in (1, 2):
        shift = 64 - step * bits
        ranges = _differing_ranges(*sides, shift)
        # Spark sees the size of the ranges and picks the join.
        sides = [s.withColumn("_range", F.shiftright("_key", shift)).join(ranges, "_range", "left_semi").drop("_range") for s in sides]
    left, right = (stage(s, "rows-to-match") for s in sides)
    marked = left.select(*keys, "_row", F.lit(1).alias("side")).unionByName(right.select(*keys, "_row", F.lit(-1).alias("side")))
    counts = marked.groupBy(*keys, "_row").agg(F.sum("side").alias("more"), F.count_if(F.col("side") > 0).alias("a"), F.count_if(F.col("side") < 0).alias("b"))
    found = counts.groupBy(*keys).agg(F.count_if(F.col("more") != 0).alias("differ"), F.sum("a").alias("a"), F.sum("b").alias("b")).filter("differ > 0")
    change = F.when(F.col("b") == 0, "missing").when(F.col("a") == 0, "extra").when((F.col("a") == 1) & (F.col("b") == 1), "changed").otherwise("repeated")
    found = found.select(*keys, change.alias("change"))
    others = [c for c in columns if c not in keys]

    def named(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*[F.col(f"`{k}`").alias(f"{mark}k{i}") for i, k in enumerate(keys)], *[F.col(f"`{c}`").alias(f"{mark}{i}") for i, c in enumerate(others)])

    def on(df: DataFrame, mark: str) -> Column:
        return reduce(lambda x, y: x & y, [df[k].eqNullSafe(F.col(f"{mark}k{i}")) for i, k in enumerate(keys)])

    changed = found.filter("change = 'changed'")
    pairs = changed.join(named(left, "a"), on(changed, "a")).join(named(right, "b"), on(changed, "b"))
    names = F.filter(
        F.array(*[F.when(~F.col(f"a{i}").eqNullSafe(F.col(f"b{i}")), F.lit(c)) for i, c in enumerate(others)]).cast("array<string>"),
        lambda c: c.isNotNull(),
    )
    rest = found.filter("change <> 'changed'").withColumn("columns", F.array().cast("array<string>"))
    return pairs.select(*keys, "change", names.alias("columns")).unionByName(rest)
