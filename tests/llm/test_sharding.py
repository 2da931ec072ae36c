from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from tallywood.llm import sharding
from tallywood.llm.queries import QUERIES


def check(found, docs, shards, tolerance):
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs
    )
    loads, places = Counter(), defaultdict(list)
    for r in found:
        assert 0 <= r.shard < shards
        loads[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    for held in places.values():
        assert sorted(held) == list(range(len(held)))
    mean = sum(loads.values()) / shards
    assert max(loads.values()) <= (1 + tolerance) * mean and min(loads.values()) >= (1 - tolerance) * mean


def test_query(spark, folder):
    folder = folder.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    check(QUERIES["op9_virtual_slot_shards"](spark, folder).collect(), docs, 40, 0.1)


def test_odd_rows_and_a_hot_id(spark):
    rows = [(None, None)] * 3000 + [(5, "same text")] * 3000 + [(10 + i, "é" * (i % 50)) for i in range(3000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id int, text string, size int")
    found = sharding.shard(docs, shards=8).collect()
    check(found, rows, 8, 0.02)
    assert len({r.virtual_slot for r in found if r.doc_id is None}) > 200
    assert sharding.shard(docs.limit(0)).count() == 0


def test_map_puts_the_largest_slot_into_the_emptiest_shard(spark):
    sizes = [(i, (i * 7919) % 101, 1) for i in range(60)]
    frame = spark.createDataFrame(sizes, "virtual_slot int, bytes bigint, rows bigint")
    loads, expected = [0] * 7, {}
    for slot, size, _ in sorted(sizes, key=lambda s: (-s[1], s[0])):
        at = loads.index(min(loads))
        loads[at] += size
        expected[slot] = at
    assert {r.virtual_slot: r.shard for r in sharding.first_map(frame, 7).collect()} == expected


def test_growth_moves_slots_into_new_shards_only(spark, tmp_path):
    sizes = spark.createDataFrame(
        [(i, 100 + (i * 31) % 17, 1) for i in range(400)], "virtual_slot int, bytes bigint, rows bigint"
    )
    sharding.write_map(sharding.first_map(sizes, 4), str(tmp_path), 1)
    before = sharding.read_map(spark, str(tmp_path), 1)
    sharding.write_map(sharding.edited_map(before, sizes, 6), str(tmp_path), 2)
    old = {r.virtual_slot: r.shard for r in before.collect()}
    after = sharding.read_map(spark, str(tmp_path), 2).collect()
    loads = Counter()
    for r in after:
        assert r.shard == old[r.virtual_slot] or r.shard in (4, 5)
        loads[r.shard] += r.bytes
    assert len(after) == 400 and max(loads.values()) < 1.05 * min(loads.values())
    same = sharding.edited_map(before, sizes, 4).collect()
    assert {r.virtual_slot: r.shard for r in same} == old


def test_no_python_on_the_executors(spark, folder, plan_text):
    assert "Python" not in plan_text(QUERIES["op9_virtual_slot_shards"](spark, folder))
