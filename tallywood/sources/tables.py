"""Keyed tables, overwritten tables and published messages."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.plans.scratch import materialized


# Parts of a keyed or insert-overwritten table; a write replaces those it has rows for. A
# large table with small writes wants more of them.
BUCKETS = 32


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table as it is now, or None where nothing is stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def keyed_write(
    df: DataFrame,
    path: str,
    key: str | None = None,
    order_by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """Write rows to a keyed table; equal keys overwrite each other.

    Rows lie in buckets by their key's hash. Among equal keys of one call the row that is
    last by ``order_by`` counts, and it replaces the stored one. Spark's dynamic partition
    overwrite puts the buckets that have new rows in place of the old ones; the others are
    neither read nor written. Repeating a call changes nothing. All calls for a table take
    the same ``key``, columns and ``buckets``; one writer at a time.

    Without ``key`` every row gets a random one, so rows are only ever added.
    """
    if key is None:
        loose = df.withColumn("_key", F.expr("uuid()"))
        loose.withColumn("_bucket", F.lit(0)).write.mode("append").partitionBy("_bucket").parquet(path)
        return
    if not order_by:
        raise ValueError("a keyed write needs order_by to choose among equal keys")
    newest = F.max_by(F.struct(*df.columns), F.struct(*order_by)).alias("row")
    chosen = df.groupBy(F.col(key).alias("_group")).agg(newest).select("row.*")
    rows = chosen.select(
        "*", F.col(key).cast("string").alias("_key"), _bucket(F.col(key), buckets).alias("_bucket")
    )
    stored = _stored(df.sparkSession, path)
    if stored is not None:
        rows = materialized(rows, "keyed-rows")
        # At most ``buckets`` numbers.
        touched = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]
        same = stored["_key"].eqNullSafe(rows["_key"])
        kept = stored.where(stored["_bucket"].isin(touched)).join(rows, same, "left_anti")
        # Written apart first: the buckets read here are the ones replaced.
        rows = materialized(rows.unionByName(kept), "keyed-merged")
    # Buckets together, but split where they are large.
    together = rows.hint("rebalance", "_bucket").write.mode("overwrite")
    together.option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)


def keyed_read(spark: SparkSession, path: str) -> DataFrame:
    """The current row of every key: the table as it is stored."""
    return spark.read.parquet(path).drop("_key", "_bucket")


def overwrite_table(df: DataFrame, path: str, table: str | None = None) -> str:
    """Insert-overwrite a result into a catalog table stored under ``path``."""
    name = table or f"t_{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return name


def overwrite_buckets(
    df: DataFrame, path: str, table: str, key: str, buckets: int = BUCKETS
) -> None:
    """Insert-overwrite only those buckets of a catalog table that ``df`` has rows for.

    The table is partitioned by ``bucket``, the hash of ``key``, and made at the first call.
    A bucket's new rows take the place of all its old ones; buckets without new rows stay as
    they are. Rows with a null key are a bucket's rows like any other; no rows change nothing.
    """
    spark = df.sparkSession
    rows = df.withColumn("bucket", _bucket(F.col(key), buckets)).hint("rebalance", "bucket")
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy("bucket").option("path", path).saveAsTable(table)
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def publish(df: DataFrame, key: Column, value: Column, topic: str) -> DataFrame:
    """Messages with binary key and value, as a topic holds them.

    Write them with ``.write.format("kafka")`` where that connector is
    installed, or to files that ``streaming.file_topic`` reads.
    """
    return df.select(
        F.lit(topic).alias("topic"),
        key.cast("string").cast("binary").alias("key"),
        value.cast("string").cast("binary").alias("value"),
    )
