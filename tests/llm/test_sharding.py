"""Jump hashing against its published loop, slots against their definition."""

import zlib

import pytest

from ohlcraft.llm import sharding


def _jump(key, shards):
    key, at, jump = key % 2 ** 64, -1, 0
    while jump < shards:
        at = jump
        key = (key * sharding.MULTIPLIER + 1) % 2 ** 64
        jump = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 24])
def test_follows_the_published_loop(spark, shards):
    keys = [0, 1, 2, 3, -1, -(2 ** 63), 2 ** 63 - 1, *range(10 ** 12, 10 ** 12 + 300), None]
    docs = spark.createDataFrame([(k, "é" * i) for i, k in enumerate(keys)], "doc_id long, text string")
    rows = sharding.jump_sharding(docs, shards).collect()
    assert len(rows) == len(keys)
    text = {k: "é" * i for i, k in enumerate(keys)}
    for row in rows:
        assert row.shard == _jump(row.doc_id or 0, shards)
        assert row.grown_shard == _jump(row.doc_id or 0, shards + 1)
        assert row.grown_shard in (row.shard, shards)
        assert row.text_crc32 == zlib.crc32(text[row.doc_id].encode())
        assert row["size"] == len(text[row.doc_id].encode()) + 8


def test_slots_have_no_gaps(spark):
    docs = spark.createDataFrame(
        [(7, None, "x")] * 90 + [(i, "t", "x") for i in range(100)], "doc_id long, text string, shard string")
    rows = sharding.jump_sharding(docs, 5).collect()
    for shard in range(5):
        own = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [r.doc_id for r in own] == sorted(r.doc_id for r in own)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.jump_sharding(docs, 3).count() == 0
