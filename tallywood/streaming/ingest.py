"""Incremental ingest: key-value message streams into idempotent sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# Bounds of one batch, so that a backlog of any size is read in many.
FILES_PER_BATCH = 1000
OFFSETS_PER_BATCH = 50_000_000


def kafka_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a Kafka topic; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    bounds = {"maxOffsetsPerTrigger": OFFSETS_PER_BATCH, **options}
    return reader.option("subscribe", topic).options(**bounds).load()


def file_topic(
    spark: SparkSession,
    path: str,
    schema: StructType,
    glob: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Rows of Parquet files as they appear under a path, so many files at a time."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)


def messages_as_text(stream: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Binary key and value as text columns ``id`` and ``val``."""
    return stream.select(
        F.col(key).cast("string").alias("id"), F.col(value).cast("string").alias("val")
    )


def append_files(
    stream: DataFrame, path: str, checkpoint: str, keep_running: bool = False
) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once.

    Stops when everything that is there has been read, unless ``keep_running``.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer if keep_running else writer.trigger(availableNow=True)).start()


def idempotent_batches(
    stream: DataFrame, path: str, checkpoint: str, keep_running: bool = False
) -> StreamingQuery:
    """Write every batch under its own number, so that a repeat replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer if keep_running else writer.trigger(availableNow=True)).start()


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of ``idempotent_batches``, with their batch number."""
    whole = StructType(schema.fields).add("batch_id", "long")
    return spark.read.schema(whole).parquet(path)


def jdbc_batches(
    stream: DataFrame,
    url: str,
    table: str,
    checkpoint: str,
    properties: Mapping[str, str] | None = None,
    keep_running: bool = False,
) -> StreamingQuery:
    """Append every batch to one database table, with its number in ``batch_id``.

    Rows go over many connections that do not commit together, so a failed batch may
    be half written. Its repeat first deletes the rows of its number, over one
    connection of the driver; ``batch_id`` should have an index.
    """
    options = dict(properties or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        settings = spark._jvm.java.util.Properties()
        for name, value in options.items():
            settings.setProperty(name, value)
        if "driver" in options:
            spark._jvm.java.lang.Class.forName(options["driver"])
        connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            there = connection.getMetaData().getTables(None, None, table, None).next()
            if there:
                connection.createStatement().executeUpdate(
                    f"DELETE FROM {table} WHERE batch_id = {int(batch_id)}"
                )
        finally:
            connection.close()
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").jdbc(
            url, table, properties=options
        )

    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer if keep_running else writer.trigger(availableNow=True)).start()
