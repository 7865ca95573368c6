"""Reports on rows that break a table's key, code sets or references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mealmarts.schemas import Contract


def key_violations(df: DataFrame, spec: Contract) -> DataFrame:
    """Keys that occur more than once, as text, with their number of rows."""
    return (
        df.groupBy(*spec.key)
        .agg(F.count("*").alias("row_count"))
        .filter("row_count > 1")
        .select(
            F.lit(spec.name).alias("table_name"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.key]).alias("key_text"),
            "row_count",
        )
    )


def domain_violations(df: DataFrame, table: str, column: str, domain: tuple[str, ...]) -> DataFrame:
    """Values outside a code set, with their number of rows. Null is allowed."""
    return (
        df.filter(~F.col(column).isin(*domain))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "row_count")
    )


def domain_report(df: DataFrame, spec: Contract) -> DataFrame:
    """``domain_violations`` of every column the contract gives a code set."""
    checks = [domain_violations(df, spec.name, c, codes) for c, codes in spec.domains.items()]
    return reduce(DataFrame.unionByName, checks)


def reference_report(df: DataFrame, spec: Contract, parents: dict[str, DataFrame]) -> DataFrame:
    """``orphan_keys`` of every column the contract lets refer to one of ``parents``, by table name."""
    checks = [orphan_keys(df, parents[t], spec.name, c) for c, t in spec.references.items() if t in parents]
    return reduce(DataFrame.unionByName, checks)


def orphan_keys(df: DataFrame, parent: DataFrame, table: str, column: str) -> DataFrame:
    """References without a parent row. Rows are counted per key before the join."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .join(parent.select(column), column, "left_anti")
        .select(F.lit(table).alias("table_name"), F.col(column).alias("key_value"), "row_count")
    )


def contract_report(df: DataFrame, spec: Contract) -> DataFrame:
    """Rows and nulls per column after the rows went into an empty table of the contract."""
    loaded = spec.empty(df.sparkSession).unionByName(spec.enforce(df))
    counts = loaded.agg(
        F.count("*").alias("_rows"), *[F.count(f.name).alias(f"_n_{i}") for i, f in enumerate(spec.schema)]
    )
    columns = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.name in spec.key).alias("is_key"),
            (F.col("_rows") - F.col(f"_n_{i}")).alias("null_count"),
        )
        for i, f in enumerate(spec.schema)
    ]
    return counts.select("_rows", F.explode(F.array(*columns)).alias("c")).select(
        F.lit(spec.name).alias("table_name"), "c.*", F.col("_rows").alias("row_count")
    )
