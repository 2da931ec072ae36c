"""Streams end to end over files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywood import sources, streaming


def write_topic(spark, path, low, high):
    frame = spark.range(low, high)
    sources.publish(frame, F.col("id"), F.concat(F.lit("m"), "id"), "t").coalesce(1).write.mode(
        "append"
    ).parquet(path)


def test_append_picks_up_where_it_left_off(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "out", "checkpoint"))
    write_topic(spark, topic, 0, 10)
    schema = spark.read.parquet(topic).schema

    def run():
        stream = streaming.file_topic(spark, topic, schema)
        text = streaming.messages_as_text(stream)
        streaming.append_files(text, out, checkpoint).awaitTermination()
        return spark.read.schema(text.schema).parquet(out)

    assert run().count() == 10
    write_topic(spark, topic, 10, 15)
    found = run()
    assert sorted((r["id"], r["val"]) for r in found.collect()) == sorted(
        (str(i), f"m{i}") for i in range(15)
    )
    assert run().count() == 15


def test_repeated_batch_replaces_itself(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    write_topic(spark, topic, 0, 5)
    write_topic(spark, topic, 5, 9)
    schema = spark.read.parquet(topic).schema
    # Two runs without a common checkpoint stand for batches that are run again.
    for attempt in ("a", "b"):
        stream = streaming.file_topic(spark, topic, schema, files_per_batch=1)
        text = streaming.messages_as_text(stream)
        streaming.idempotent_batches(text, out, str(tmp_path / attempt)).awaitTermination()
    found = streaming.read_batches(spark, out, text.schema)
    assert found.count() == 9
    assert {r["batch_id"] for r in found.collect()} == {0, 1}
