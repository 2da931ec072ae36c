"""Shards of nearly equal bytes, by fixed virtual slots and a versioned slot map.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.plans.scratch import materialized, scratch_path

SHARDS = 40
# Fixed for the life of a dataset: three hexadecimal digits.
SLOTS = 4096
# Bytes that a record takes besides its text.
OVERHEAD = 16


def records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, task, virtual_slot) of every row, written once.

    A record's slot is a hash of its id alone; of rows that share an id within one
    input partition the second, third, ... hash their number with it, so an id with
    any share of the rows (null too) fills many slots. No group grows with the data:
    an id is numbered within one input partition.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialized(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.spark_partition_id().alias("task"),
        ),
        "records",
    )
    same_id = Window.partitionBy("task", "doc_id").orderBy("size", "text_crc32")
    number = F.row_number().over(same_id)
    name = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        F.when(F.col("number") > 1, F.concat(F.lit("#"), F.col("number"))).otherwise(""),
    )
    slot = F.conv(F.substring(F.md5(name.cast("binary")), 1, 3), 16, 10).cast("int")
    return materialized(
        rows.withColumn("number", number).select("*", slot.alias("virtual_slot")), "slotted"
    )


def slot_sizes(slotted: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows): SLOTS rows at most, aggregated before the shuffle."""
    return slotted.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(virtual_slot, shard, bytes, rows): the largest slot to the emptiest shard.

    One fold over the sorted array of at most SLOTS slots; ties go to the smaller slot
    and the smaller shard.
    """
    kind = "struct<loads: array<bigint>, picks: array<struct<virtual_slot: int, shard: int>>>"
    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), shards).alias("loads"),
        F.array().cast("array<struct<virtual_slot: int, shard: int>>").alias("picks"),
    ).cast(kind)

    def put(state, slot):
        loads = state["loads"]
        emptiest = F.array(F.array_position(loads, F.array_min(loads)).cast("int"))
        return F.element_at(
            F.transform(
                emptiest,
                lambda at: F.struct(
                    F.transform(
                        loads, lambda v, i: F.when(i + 1 == at, v + slot["bytes"]).otherwise(v)
                    ).alias("loads"),
                    F.concat(
                        state["picks"],
                        F.array(F.struct(
                            slot["virtual_slot"].alias("virtual_slot"), (at - 1).alias("shard")
                        )),
                    ).alias("picks"),
                ).cast(kind),
            ),
            1,
        )

    largest = F.array_sort(
        F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "bytes"))
    )
    picks = sizes.agg(largest.alias("slots")).select(
        F.inline(F.aggregate("slots", start, put)["picks"])
    )
    return picks.join(F.broadcast(sizes), "virtual_slot")


def edited_map(before: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The map for ``shards`` shards after growth, moving slots into new shards only.

    ``sizes`` may be newer than the map; slots the map lacks go where their number
    says. Every old shard gives its smallest slots as long as it stays above the new
    average; they are dealt to the new shards in turn.
    """
    old = before.agg((F.max("shard") + 1).alias("n")).first()["n"] or 0
    now = sizes.join(F.broadcast(before.select("virtual_slot", "shard")), "virtual_slot", "left")
    now = now.withColumn(
        "shard", F.coalesce("shard", F.col("virtual_slot") % max(old, 1)).cast("int")
    )
    if shards <= old:
        return now
    own = Window.partitionBy("shard")
    surplus = F.sum("bytes").over(own) - F.sum("bytes").over(Window.partitionBy()) / shards
    given = F.sum("bytes").over(own.orderBy("bytes", "virtual_slot"))
    marked = now.select("*", (given <= surplus).alias("goes"))
    turn = F.row_number().over(Window.partitionBy("goes").orderBy(F.desc("bytes"), "virtual_slot"))
    target = (F.lit(old) + (turn - 1) % (shards - old)).cast("int")
    return marked.select(
        "virtual_slot", "bytes", "rows",
        F.when(F.col("goes"), target).otherwise(F.col("shard")).alias("shard"),
    )


def write_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Store a version of the map beside the earlier ones; a version is never changed."""
    slot_map.select("virtual_slot", "shard", "bytes", "rows").coalesce(1).write.parquet(
        f"{path}/version={version}"
    )


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int, bytes bigint, rows bigint").parquet(
        f"{path}/version={version}"
    )


def place(slotted: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Rows stand by virtual slot, then id: numbered within each slot, which holds about
    one in SLOTS rows, after the rows of the shard's smaller slots.
    """
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = slot_map.select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "number", "task")
    numbered = slotted.withColumn("within", F.row_number().over(within) - 1)
    # At most SLOTS rows of three numbers.
    return numbered.join(F.broadcast(starts), "virtual_slot").withColumn(
        "slot", F.col("start") + F.col("within")
    )


def shard(docs: DataFrame, shards: int = SHARDS, map_path: str | None = None) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into a shard; shards have near equal bytes.

    doc_id, size (UTF-8 bytes of the text and 16), text_crc32, shard, slot (place in the
    shard, gapless from 0), virtual_slot. Version 1 of the slot map is written to
    ``map_path`` (the shared folder by default); ``edited_map`` makes later ones.

    Null text: empty. Null and repeated ids are spread like others; repeated rows come
    out as often; other columns are ignored; no rows give no rows.
    """
    slotted = records(docs)
    path = map_path or scratch_path(docs.sparkSession, "slot-map")
    write_map(first_map(slot_sizes(slotted), shards), path, 1)
    placed = place(slotted, read_map(docs.sparkSession, path, 1))
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot", "virtual_slot")
