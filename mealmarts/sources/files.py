"""Readers and writers for the pipeline's file and database formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mealmarts.schemas import contract

LINES_PER_FILE = 1_000_000


def read_jdbc(spark: SparkSession, table: str, column: str, lower, upper, partitions: int, **options) -> DataFrame:
    """Table of a database in ``partitions`` ranges of ``column``; one range would be one task."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .options(dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions)
        .load()
    )


def write_jdbc(df: DataFrame, table: str, mode: str = "overwrite", **options) -> None:
    """Write to a database. Overwrite empties the table and keeps its definition; arrays go as JSON."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    flat.write.format("jdbc").mode(mode).options(**{"dbtable": table, "truncate": "true", **options}).save()


def export_csv(df: DataFrame, path: str, day: str | None = None, date_column: str = "train_date") -> None:
    """CSV with header, one date or all."""
    rows = df if day is None else df.filter(F.col(date_column) == F.lit(day).cast("date"))
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV with header, typed by the table's contract."""
    return spark.read.option("header", True).schema(contract(table).schema).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    # Null fields are kept, or a row of nulls would come back without its columns.
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_lines(df: DataFrame, path: str, column: str = "line", compression: str = "none", per_file: int = LINES_PER_FILE) -> None:
    """One text line per row; without rows the folder holds no line.

    A packed file is read by one task, so a file takes ``per_file`` lines at most and the number of files grows with the rows.
    """
    df.select(column).write.mode("overwrite").option("compression", compression).option("maxRecordsPerFile", per_file).text(path)


def list_tables(spark: SparkSession, root: str, suffix: str = ".parquet") -> list[str]:
    """Names of the tables stored below a folder. Only names come to the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [entry.getPath().getName() for entry in entries]
    return sorted(n.removesuffix(suffix) for n in names if n.endswith(suffix))


def bulk_copy(spark: SparkSession, source: str, target: str) -> list[str]:
    """Append every table below ``source`` to the table of its name below ``target``."""
    tables = list_tables(spark, source)
    for table in tables:
        spark.read.parquet(f"{source}/{table}.parquet").write.mode("append").parquet(f"{target}/{table}.parquet")
    return tables
