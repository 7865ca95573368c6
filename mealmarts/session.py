"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Cluster settings stay with spark-submit; these only cover what results depend on or
# what the plans count on (run-time re-planning, skewed joins split even below an aggregate).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_SHIPPED: set[str] = set()


def build_session(app_name: str = "mealmarts", master: str | None = None, **conf) -> SparkSession:
    """Session with the library's defaults; keyword arguments use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder; on a cluster an unset folder
    is an error, as a machine-local path would be lost with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if configured is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="mealmarts-"))
    return (configured or sc.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's part of the shared folder, to be removed after it ends."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, lineage cut, columns prunable.

    For a result several branches of a job read, or one row per key that large tables are
    joined to: Spark then knows its size, and finds a plain shuffle on both sides of the
    join, which is what adaptive execution needs to split a hot key. (Straight from an
    aggregate on the join key there is no such shuffle, and a hot key stays in one task.)
    A lost executor costs its own tasks only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python of the application's executors, once."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"plans-{package.name}"
        context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


def tune(spark: SparkSession) -> None:
    """What the plans count on, for a session made elsewhere: hot keys of joins are split at run time."""
    for key in (
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.adaptive.forceOptimizeSkewedJoin",
    ):
        spark.conf.set(key, DEFAULTS[key])


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this application staged. To be called at its end: frames read from there are gone then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
