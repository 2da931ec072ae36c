"""Shared scratch space and caching.

Intermediate tables and checkpoints go to the folder the cluster names in
``spark.checkpoint.dir``, which every executor can reach, so that a lost
executor never takes intermediate results with it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables.

    Only a local session may go without the setting; it then gets a fresh
    temporary folder. On a cluster such a folder would be private to one
    machine, so the setting is required there.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is None:
        # ``local-cluster[...]`` has executors of their own.
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallywood-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and go on from the written table.

    For results that are costly and read more than once: later steps scan only
    the columns they need, and a lost executor costs none of the work before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def persisted(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Cache a frame for the block that reads it many times.

    The rows are first evened out to partitions of the advisory size, so that
    no pass waits for a few large input splits.
    """
    held = df.hint("rebalance").persist(level)
    try:
        yield held
    finally:
        held.unpersist()
