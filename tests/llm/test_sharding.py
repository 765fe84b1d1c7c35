import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.sharding import MULTIPLIER, jump_shard, shard_documents


def jump(key: int, shards: int) -> int:
    """The published algorithm, step by step."""
    key, shard, ahead = key & (2**64 - 1), -1, 0
    while ahead < shards:
        shard = ahead
        key = (key * MULTIPLIER + 1) & (2**64 - 1)
        ahead = int((shard + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return shard


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 70, 1000])
def test_equal_to_the_published_steps(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(k * 0x9E3779B97F4A7C for k in range(-9, 200))]
    keys = spark.createDataFrame([(k,) for k in keys], "k long")
    for row in keys.select("k", jump_shard(F.col("k"), shards).alias("s")).collect():
        assert row.s == jump(row.k, shards)


def test_no_shards():
    with pytest.raises(ValueError):
        jump_shard(None, 0)


def test_odd_rows(documents, odd_rows):
    rows = shard_documents(documents(odd_rows), shards=4, slices=8).collect()
    got = sorted((r.doc_id or 0, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows)
    assert got == sorted(
        (i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(i or 0, 4), jump(i or 0, 5))
        for i, t in odd_rows
    )
    for shard in range(4):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 4) for r in rows)


def test_empty(documents):
    assert shard_documents(documents([])).count() == 0


def test_native(documents, odd_rows):
    plan = shard_documents(documents(odd_rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
