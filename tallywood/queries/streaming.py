"""Streams over the event table's files, run until all of it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood import sources, streaming
from tallywood.plans import scratch_path
from tallywood.queries.registry import Tables, query


def _event_messages(t: Tables) -> DataFrame:
    """The event table as a stream of binary key and value."""
    schema = t.events.schema
    stream = streaming.file_topic(t.spark, f"{t.folder}/events.parquet*", schema)
    return sources.publish(stream, F.col("event_id"), F.col("props"), "events")


@query(
    "stream_cast_append",
    "SELECT CAST(event_id AS VARCHAR) AS id, props AS val FROM events",
)
def stream_cast_append(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "stream-out")
    messages = streaming.messages_as_text(_event_messages(t))
    streaming.append_files(
        messages, path, scratch_path(t.spark, "stream-checkpoint")
    ).awaitTermination()
    return t.spark.read.schema(messages.schema).parquet(path)


@query(
    "stream_foreach_batch_sink",
    "SELECT CAST(event_id AS VARCHAR) AS id, props AS val FROM events",
)
def stream_foreach_batch_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "batches")
    messages = streaming.messages_as_text(_event_messages(t))
    streaming.idempotent_batches(
        messages, path, scratch_path(t.spark, "batch-checkpoint")
    ).awaitTermination()
    # Every row belongs to exactly one batch, however they were cut.
    return streaming.read_batches(t.spark, path, messages.schema).select("id", "val")


@query(
    "publish_messages",
    """SELECT CAST(event_id AS VARCHAR) AS id,
              event_id || ': this is event ' || event_id || ' of type ' || event_type AS val
       FROM events""",
)
def publish_messages(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "topic")
    text = F.concat(
        "event_id", F.lit(": this is event "), "event_id", F.lit(" of type "), "event_type"
    )
    sources.publish(t.events, F.col("event_id"), text, "events").write.parquet(path)
    return streaming.messages_as_text(t.spark.read.parquet(path))
