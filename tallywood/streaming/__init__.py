from tallywood.streaming.ingest import (
    append_files,
    file_topic,
    idempotent_batches,
    jdbc_batches,
    kafka_topic,
    messages_as_text,
    read_batches,
)

__all__ = [
    "append_files",
    "file_topic",
    "idempotent_batches",
    "jdbc_batches",
    "kafka_topic",
    "messages_as_text",
    "read_batches",
]
