"""Near-duplicate documents by SimHash fingerprints and Golay-code keys."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.llm import golay
from tallywood.llm.components import connected_components
from tallywood.llm.frames import texts_of
from tallywood.plans.scratch import materialized

MOST_BITS = 3
# A key held by more fingerprints than this is refined by further bits.
WIDE_KEY = 4096
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text over word shingles, as a signed integer.

    A-Z are lower-cased, words end at ASCII white space. A shingle is ``words``
    successive words joined by spaces; a text of fewer is one shingle; one
    without words has fingerprint zero. A bit is set where over half the XXH64
    values of the shingles have it, repeated shingles counting again.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    width = min(words, len(parts))
    ends = np.cumsum([len(p) + 1 for p in parts]).tolist()
    starts = [0, *ends]
    total = len(parts) - width + 1
    counts = np.zeros(64, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, total, SHINGLES_AT_ONCE):
        to = min(at + SHINGLES_AT_ONCE, total)
        spans = zip(starts[at:to], ends[at + width - 1 : to + width - 1])
        values = np.array([hashed(joined[a : b - 1], seed) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; one pass, nothing is shuffled. Null text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(values, pa.int64())], ["doc_id", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def _segments(values: np.ndarray) -> list[np.ndarray]:
    unsigned = values.view(np.uint64)
    return [((unsigned >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]


def _keyed(fps: DataFrame, near: bool) -> DataFrame:
    """(key, fp): a key is one segment as it is and a codeword index of the next one.

    Of three wrong bits in four segments, some segment i has none while segment
    i + 1 has at most one: otherwise every segment without error would be followed
    by the one segment with two errors or more, and there are at least two of them.
    One side is keyed by its own codeword (4 keys), the other by the codewords of all
    words within one bit (about 20 keys), so such a pair meets at least once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = golay.own_keys()
        starts, values = golay.near_keys()
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            parts = _segments(fp)
            for i in range(4):
                exact, fuzzy = parts[i], parts[(i + 1) % 4]
                head = (i << 28) | (exact << 12)
                if near:
                    n = starts[fuzzy + 1] - starts[fuzzy]
                    shift = starts[fuzzy] - np.concatenate([[0], n.cumsum()[:-1]])
                    index = values[np.arange(n.sum()) + np.repeat(shift, n)]
                    key, owner = np.repeat(head, n) | index, np.repeat(fp, n)
                else:
                    key, owner = head | own[fuzzy], fp
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(owner)], ["key", "fp"])

    return fps.mapInArrow(run, "key bigint, fp bigint")


def _refined(keyed: DataFrame, wide: DataFrame) -> DataFrame:
    """Add ``part``: for a wide key, each choice of five of the eight 4-bit blocks that
    the key leaves open; three wrong bits leave some five blocks as they are."""
    per_key = []
    for i in range(4):
        open_bits = [16 * ((i + 2) % 4), 16 * ((i + 3) % 4)]
        blocks = [0xF << (at + 4 * b) for at in open_bits for b in range(4)]
        masks = [sum(chosen) for chosen in combinations(blocks, 5)]
        per_key.append([m - (1 << 64) if m >> 63 else m for m in masks])
    masks = F.element_at(
        F.array(*[F.array(*[F.lit(m).cast("bigint") for m in row]) for row in per_key]),
        (F.shiftright("key", 28) + 1).cast("int"),
    )
    parts = F.transform(
        masks, lambda m, n: F.struct(n.cast("int").alias("n"), F.col("fp").bitwiseAND(m).alias("bits"))
    )
    none = F.array(F.struct(F.lit(-1).alias("n"), F.lit(0).cast("bigint").alias("bits")))
    marked = keyed.join(wide.select("key", F.lit(True).alias("is_wide")), "key", "left")
    chosen = F.when(F.col("is_wide"), parts).otherwise(none)
    return marked.select("key", "fp", F.explode(chosen).alias("part"))


def fingerprint_links(fps: DataFrame, wide_key: int = WIDE_KEY) -> DataFrame:
    """Pairs (low, high) of distinct fingerprints that differ in three bits or fewer.

    ``fps``: distinct values in ``fp``. Every such pair comes out, once or several
    times. A key that very many fingerprints share is refined first, so that no
    bucket grows with the data; nothing is dropped.
    """
    own, near = _keyed(fps, near=False), _keyed(fps, near=True)
    sizes = own.groupBy("key").count().where(F.col("count") > wide_key).select("key")
    wide = materialized(sizes, "wide-keys")
    on = ["key"]
    if not wide.isEmpty():
        own, near = _refined(own, wide), _refined(near, wide)
        on = ["key", "part"]
    a, b = own.withColumnRenamed("fp", "low"), near.withColumnRenamed("fp", "high")
    pairs = a.join(b, on).select("low", "high").where("low != high")
    return pairs.where(F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= MOST_BITS)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_components(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text).

    Fingerprints link at three differing bits or fewer; component_id is the
    smallest doc_id that links reach, the document's own included. Equal
    fingerprints, also those of empty texts, are one vertex, so copies cost
    nothing after they are counted. A row with a null doc_id takes part and never
    gives its id; component_id is null where all ids are. Repeated rows come out
    as often as they came in; other columns are ignored; no rows give no rows.
    """
    own = materialized(fingerprints(docs, words), "fingerprints")
    vertices = own.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = fingerprint_links(vertices.select("fp"))
    parts = connected_components(links).withColumnRenamed("vertex", "fp")
    labelled = vertices.join(parts, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = labelled.select("fp", "component").join(smallest, "component")
    return own.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )
