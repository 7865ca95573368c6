"""Set-based forms of the three row-insert strategies, and partition-wise storing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from mealmarts.operators.ranking import one_per_key
from mealmarts.schemas import Contract, contract
from mealmarts.session import stage


OrderBy = str | Sequence[str] | None


class DuplicateKeyError(ValueError):
    """A plain append met a key that exists already, or twice in the batch."""


class NullKeyError(ValueError):
    """A row to be stored has no value in a key column."""


def _row_order(df: DataFrame, order_by: OrderBy) -> list[str]:
    if order_by is None:
        return list(df.columns)
    return [order_by] if isinstance(order_by, str) else list(order_by)


def _first(df: DataFrame, keys: Sequence[str], order_by: OrderBy) -> DataFrame:
    return one_per_key(df, keys, [F.col(c).asc_nulls_first() for c in _row_order(df, order_by)])


def _last(df: DataFrame, keys: Sequence[str], order_by: OrderBy) -> DataFrame:
    return one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in _row_order(df, order_by)])


def key_collisions(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys a plain append would store twice: repeats inside the batch, and batch keys the target has.

    What the target repeats on its own is not the batch's fault. Only batch keys are grouped.
    """
    repeats = batch.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)
    return repeats.unionByName(batch.select(*keys).join(target.select(*keys), list(keys), "left_semi")).distinct()


def load_append(target: DataFrame, batch: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """Target plus batch; any key collision is an error."""
    if check and not key_collisions(target, batch, keys).isEmpty():
        raise DuplicateKeyError(f"append would repeat a key of {list(keys)}")
    return target.unionByName(batch)


def load_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: OrderBy = None) -> DataFrame:
    """Existing keys win; of repeated batch keys the first row wins."""
    fresh = _first(batch, keys, order_by).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh)


def load_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: OrderBy = None) -> DataFrame:
    """Batch rows replace existing keys, all columns and nulls included; the last duplicate wins."""
    newest = _last(batch, keys, order_by)
    kept = target.join(newest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(newest)


STRATEGIES = {"append": load_append, "ignore": load_ignore, "overwrite": load_upsert}


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Stored table, or an empty frame with its contract's columns."""
    spec = contract(table)
    try:
        return spec.enforce(spark.read.parquet(f"{root}/{table}"))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spec.empty(spark)
        raise


def store(batch: DataFrame, root: str, table: str, strategy: str = "append", order_by: OrderBy = None) -> None:
    """Load a batch into a stored table.

    Only the date partitions the batch touches are read, merged and rewritten: the batch's dates
    reach the target's scan as literals. Partition columns are part of the key, so no row outside
    them can hold a batch key; a null in a key is refused. ``order_by`` names the batch columns that
    tell which of several rows with one key came first; they need not be stored. The batch is staged,
    so it is read once; so are the merged rows, as their source files are replaced by this very write.
    """
    spec = contract(table)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown load strategy: {strategy}")
    spark = batch.sparkSession
    if strategy == "append" or order_by is None:
        rows = spec.enforce(batch)
    else:
        pick = _first if strategy == "ignore" else _last
        rows = spec.enforce(pick(batch, spec.key, order_by))
    rows = stage(rows, f"{table}-batch")
    _refuse_null_keys(rows, spec)
    target = _touched(read_table(spark, root, table), rows, spec)
    if strategy == "append":
        if not key_collisions(target, rows, spec.key).isEmpty():
            raise DuplicateKeyError(f"append would repeat a key of {table}")
        _writer(rows, spec).mode("append").parquet(f"{root}/{table}")
        return
    merged = stage(STRATEGIES[strategy](target, rows, spec.key), table)
    _writer(merged, spec).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{table}")


def replace_table(rows: DataFrame, root: str, table: str) -> None:
    """Whole-table overwrite, as every mart job ends with: what is not in ``rows`` is gone.

    The contract's columns are written next to the table first. Only then the old folder makes
    way for the new one, so a failing job leaves the old rows in place.
    """
    spec = contract(table)
    fresh, old = f"{root}/_{table}.new", f"{root}/_{table}.old"
    _writer(spec.enforce(rows), spec).mode("overwrite").parquet(fresh)
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(old), True)
    if files.exists(path(f"{root}/{table}")) and not files.rename(path(f"{root}/{table}"), path(old)):
        raise OSError(f"cannot set aside {root}/{table}")
    if not files.rename(path(fresh), path(f"{root}/{table}")):
        raise OSError(f"cannot put {table} in place; its rows are in {fresh}")
    files.delete(path(old), True)


def replace_parts(batch: DataFrame, root: str, table: str) -> None:
    """The batch's partitions are written anew, all others stay. A load of this kind can run again."""
    spec = contract(table)
    if not spec.partition_by:
        raise ValueError(f"{table} is not partitioned")
    rows = spec.enforce(batch)
    _writer(rows, spec).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{table}")


def replace_days(batch: DataFrame, root: str, table: str) -> None:
    """Daily fact load that can run again: the batch's date partitions are written anew."""
    replace_parts(batch, root, table)


def stored_parts(spark: SparkSession, root: str, table: str) -> list[str]:
    """Values of the stored partitions, ascending as text. Only folder names are read."""
    spec, path = contract(table), spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(path)]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{spec.partition_by}="))


def drop_parts(spark: SparkSession, root: str, table: str, parts: Sequence[object]) -> None:
    """Delete stored partitions; one that is not there is no error."""
    column, path = contract(table).partition_by, spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for part in parts:
        files.delete(path(f"{root}/{table}/{column}={part}"), True)


class ChangedBatchError(ValueError):
    """A load was sent again under its id with other rows."""


def _load_path(root: str, table: str) -> str:
    return f"{root}/{table}_loads"


def append_once(batch: DataFrame, root: str, table: str, load_id: str) -> bool:
    """Append a dated batch under an id; sent again it changes nothing. True if its rows are new.

    Rows go to a partition of their own per load, which a retry writes anew, so a run that broke off leaves
    nothing twice. The ledger names a load only when its rows are complete; ``read_loads`` shows no others. A batch
    that comes again under its id must have the same rows (count and sum of row hashes). A key that an earlier
    load of the same dates holds is refused, as by a plain append.
    """
    spec, spark = contract(table), batch.sparkSession
    rows = stage(spec.enforce(batch), f"{table}-batch")
    _refuse_null_keys(rows, spec)
    n, hashes = rows.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
    known = read_table(spark, root, "load_ledger").filter(F.col("load_id") == load_id).first()
    if known is not None:
        if (known.n_rows, known.row_hashes) != (n, hashes):
            raise ChangedBatchError(f"{table}: load {load_id} was stored with other rows")
        return False
    target = _touched(read_loads(spark, root, table), rows, spec)
    if not key_collisions(target, rows, spec.key).isEmpty():
        raise DuplicateKeyError(f"append would repeat a key of {table}")
    # The whole partition of the load goes first: a broken run may have written dates this one has not.
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_load_path(root, table)}/load_id={load_id}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    parts = ["load_id", spec.partition_by] if spec.partition_by else ["load_id"]
    rows.withColumn("load_id", F.lit(load_id)).write.mode("append").partitionBy(*parts).parquet(_load_path(root, table))
    replace_parts(spark.createDataFrame([(load_id, n, hashes)], contract("load_ledger").schema), root, "load_ledger")
    return True


def read_loads(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of all complete loads. The ledger has a row per load."""
    spec = contract(table)
    layout = T.StructType([*spec.schema.fields, T.StructField("load_id", T.StringType())])
    try:
        rows = spark.read.schema(layout).parquet(_load_path(root, table))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spec.empty(spark)
        raise
    done = read_table(spark, root, "load_ledger").select("load_id")
    return rows.join(done, "load_id", "left_semi").select(*spec.schema.names)


def _refuse_null_keys(rows: DataFrame, spec: Contract) -> None:
    missing = F.lit(False)
    for column in spec.key:
        missing = missing | F.col(column).isNull()
    if not rows.filter(missing).isEmpty():
        raise NullKeyError(f"{spec.name}: null in a key column of {list(spec.key)}")


def _touched(target: DataFrame, batch: DataFrame, spec: Contract) -> DataFrame:
    """Rows of the batch's dates. A batch has a handful of dates; at most one per day of the calendar."""
    if not spec.partition_by:
        return target
    days = [row[0] for row in batch.select(spec.partition_by).distinct().collect()]
    return target.filter(F.col(spec.partition_by).isin(days)) if days else target.limit(0)


def _writer(df: DataFrame, spec: Contract):
    if not spec.partition_by:
        return df.write
    # A rebalance keeps one day's rows together but splits a day that is too large for one file.
    return df.hint("rebalance", F.col(spec.partition_by)).write.partitionBy(spec.partition_by)


def stamp(df: DataFrame, column: str, day: str | Column) -> DataFrame:
    """Rows with their load date, ready to be stored."""
    value = day if isinstance(day, Column) else F.lit(day)
    return df.withColumn(column, value.cast("date"))
