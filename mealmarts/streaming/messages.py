"""Topic messages as a bounded batch and as a stream.

The connector is an option: ``kafka`` where its jar is on the class path, else any file
format that holds ``key`` and ``value`` columns, which is how the tests run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from mealmarts.operators.ranking import greatest_row
from mealmarts.session import stage

# Layout of a topic row and of a parsed message.
TOPIC_SCHEMA = T.StructType().add("key", T.BinaryType()).add("value", T.BinaryType())
MESSAGE_SCHEMA = T.StructType().add("message", T.StringType())
PLACE = ("partition", "offset")
PLACED_SCHEMA = T.StructType().add("partition", T.IntegerType()).add("offset", T.LongType()).add("key", T.BinaryType()).add("value", T.BinaryType())


def _options(fmt: str, options: dict) -> dict:
    return {"startingOffsets": "earliest", **options} if fmt == "kafka" else options


def read_topic(spark: SparkSession, path: str | None = None, fmt: str = "kafka", **options) -> DataFrame:
    """Everything the topic holds now, from the earliest message."""
    reader = spark.read.format(fmt).options(**_options(fmt, options))
    return (reader if fmt == "kafka" else reader.schema(TOPIC_SCHEMA)).load(path)


def stream_topic(
    spark: SparkSession, path: str | None = None, fmt: str = "kafka", schema: T.StructType = TOPIC_SCHEMA, **options
) -> DataFrame:
    """The topic as a stream, from the earliest message."""
    reader = spark.readStream.format(fmt).options(**_options(fmt, options))
    return (reader if fmt == "kafka" else reader.schema(schema)).load(path)


def publish(messages: DataFrame, path: str | None = None, fmt: str = "kafka", **options) -> None:
    """Send ``key, value`` rows to a topic."""
    rows = messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    rows.write.format(fmt).mode("append").options(**options).save(path)


def as_text(messages: DataFrame) -> DataFrame:
    return messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def parse_json(messages: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields of the JSON value as columns; a value that is no such object gives nulls."""
    kept = [F.col(c).cast("string").alias(c) for c in keep]
    return messages.select(*kept, F.from_json(F.col("value").cast("string"), schema).alias("data")).select(*keep, "data.*")


def run_stream(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", timeout: int | None = None) -> None:
    """Append what is available to files and stop; the next run goes on from the checkpoint.

    Waits to the end, however long it takes, unless the caller sets ``timeout`` seconds.
    """
    query = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    _finish(query, timeout)


def _finish(query: StreamingQuery, timeout: int | None) -> None:
    try:
        if query.awaitTermination(timeout) is False:
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        query.stop()


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    """Messages stored by ``merge_placed``; none where nothing was stored."""
    try:
        return spark.read.schema(PLACED_SCHEMA).parquet(path).select(*PLACED_SCHEMA.names)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], PLACED_SCHEMA)
        raise


def merge_placed(batch: DataFrame, path: str) -> None:
    """Store the messages whose place (topic partition, offset) is not stored yet.

    Only places between the batch's lowest and highest offset of each topic partition are read; the bounds, a row
    per topic partition, reach the scan as literals. A place that comes twice in a batch is one message.
    """
    rows = stage(greatest_row(batch.select(*PLACED_SCHEMA.names), PLACE, ("key", "value")), "placed-messages")
    bounds = rows.groupBy("partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
    if not bounds:
        return
    place = [(F.col("partition") == b.partition) & F.col("offset").between(b.low, b.high) for b in bounds]
    stored = read_placed(batch.sparkSession, path).filter(reduce(lambda x, y: x | y, place))
    fresh = rows.join(stored.select(*PLACE), list(PLACE), "left_anti")
    fresh.write.mode("append").partitionBy("partition").parquet(path)


def run_stream_once(stream: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> None:
    """Store what is available, each message once, and stop.

    The checkpoint tells where to go on. Should it be lost, or a micro-batch run again after a failure, all messages come
    again and find their places taken. ``stream`` has the columns of ``PLACED_SCHEMA``.
    """
    writer = stream.writeStream.foreachBatch(lambda batch, _: merge_placed(batch, path))
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    _finish(query, timeout)
