import datetime as dt

import pytest

from mealmarts.schemas import CONTRACTS
from mealmarts.session import scratch_path, shared_dir, stage
from mealmarts.sources import files
from mealmarts.streaming import messages

MESSAGES = [("1", '{"message": "hi"}'), ("2", "broken"), (None, '{"message": 5, "x": 1}'), ("4", "{}")]


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(MESSAGES, "key string, value string")


def test_parse_json(batch, rows_of):
    assert rows_of(messages.parse_json(batch, keep=("key",))) == [("1", "hi"), ("2", None), ("4", None), (None, "5")]
    assert messages.parse_json(batch).columns == ["message"]


def test_json_sink_keeps_rows_of_nulls(spark, batch, rows_of):
    path = scratch_path(spark, "json")
    parsed = messages.parse_json(batch)
    files.write_json(parsed, path)
    files.write_json(parsed, path)
    assert rows_of(files.read_json(spark, path, messages.MESSAGE_SCHEMA)) == rows_of(parsed)


def test_stream_equals_batch_and_resumes(spark, batch, rows_of):
    topic, out, progress = (scratch_path(spark, n) for n in ("topic", "out", "progress"))
    messages.publish(batch, topic, "parquet")
    stream = messages.as_text(messages.stream_topic(spark, topic, "parquet"))
    messages.run_stream(stream, out, progress)
    assert rows_of(spark.read.parquet(out)) == rows_of(messages.as_text(messages.read_topic(spark, topic, "parquet")))
    more = spark.createDataFrame([("9", "late")], "key string, value string")
    messages.publish(more, topic, "parquet")
    for _ in range(2):
        messages.run_stream(messages.as_text(messages.stream_topic(spark, topic, "parquet")), out, progress)
    got = rows_of(spark.read.parquet(out))
    assert len(got) == 5 and got.count(("9", "late")) == 1


def test_messages_are_stored_once_whatever_comes_again(spark, rows_of):
    """A lost checkpoint, a repeated offset in a batch, and a run that had stored a part."""
    topic, out, progress = (scratch_path(spark, n) for n in ("topic", "out", "progress"))
    rows = [(p, o, f"{p}".encode(), f"{o}".encode()) for p in (0, 1) for o in range(20)]
    frame = lambda r: spark.createDataFrame(r, messages.PLACED_SCHEMA)
    stream = lambda: messages.stream_topic(spark, topic, "parquet", messages.PLACED_SCHEMA)
    assert rows_of(messages.read_placed(spark, out)) == []
    frame(rows[:30] + rows[:3]).write.parquet(topic)
    messages.merge_placed(frame(rows[5:9]), out)  # what a broken run had left
    for name in ("a", "a", "lost"):
        messages.run_stream_once(stream(), out, f"{progress}-{name}")
        assert rows_of(messages.read_placed(spark, out)) == sorted(((p, o, bytearray(k), bytearray(v)) for p, o, k, v in rows[:30]), key=repr)
    frame(rows[25:]).write.mode("append").parquet(topic)
    messages.run_stream_once(stream(), out, f"{progress}-a")
    stored = messages.read_placed(spark, out)
    assert stored.count() == 40 and stored.select("partition", "offset").distinct().count() == 40
    messages.merge_placed(frame([]), out)
    assert messages.read_placed(spark, out).count() == 40


def test_kafka_options():
    assert messages._options("kafka", {"subscribe": "t"}) == {"startingOffsets": "earliest", "subscribe": "t"}
    assert messages._options("kafka", {"startingOffsets": "latest"})["startingOffsets"] == "latest"
    assert messages._options("parquet", {}) == {}


def test_training_csv(spark, table, rows_of):
    spec = CONTRACTS["xgb_train_data"]
    one = dict.fromkeys(spec.schema.names) | {"user_id": 1, "menu_id": 2, "user_gender": "m", "A_tag_ratio": 1 / 3, "label": 1}
    rows = [one | {"train_date": dt.date(2025, 5, d)} for d in (1, 2)]
    df = spark.createDataFrame(rows, spec.schema)
    path = scratch_path(spark, "csv")
    files.export_csv(df, path)
    assert rows_of(files.read_csv(spark, path, "xgb_train_data")) == rows_of(df)
    files.export_csv(df, path, "2025-05-02")
    assert [r.train_date.day for r in files.read_csv(spark, path, "xgb_train_data").collect()] == [2]


def test_bulk_copy_appends_every_table(spark, rows_of):
    source, target = scratch_path(spark, "source"), scratch_path(spark, "target")
    spark.range(5).write.parquet(f"{source}/a.parquet")
    spark.createDataFrame([("x", [1.5])], "s string, v array<double>").write.parquet(f"{source}/b.parquet")
    for times in (1, 2):
        assert files.bulk_copy(spark, source, target) == ["a", "b"]
        assert rows_of(spark.read.parquet(f"{target}/a.parquet")) == sorted([(i,) for i in range(5)] * times)
    assert spark.read.parquet(f"{target}/b.parquet").first().v == [1.5]


def test_stage_cuts_lineage(spark):
    staged = stage(spark.range(10).selectExpr("id", "id * 2 AS twice"), "numbers")
    assert staged.agg({"twice": "sum"}).first()[0] == 90
    assert staged.select("id").inputFiles()[0].startswith("file:") and shared_dir(spark) in staged.inputFiles()[0]


def test_staged_values_are_typed(spark, table):
    for spec in CONTRACTS.values():
        assert spec.empty(spark).schema == spec.schema
