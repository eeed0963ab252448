import zlib

import pytest
from pyspark.sql import functions as F

from tablehaul.llm.sharding import jump_hash, shard_documents, write_shards
from tests.llm.helpers import frame, odd_rows


def jump(key, shards):
    key, b, j = (-1 if key is None else key) % 2**64, -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 16, 17, 100])
def test_jump_hash_is_the_published_one(spark, shards):
    keys = [*range(300), -1, -2**63, 2**63 - 1, None]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_hash(F.col("k"), shards)).collect()
    assert all(s == jump(k, shards) for k, s in got)


@pytest.mark.parametrize("per_block", [2, 50_000])
def test_odd_rows(spark, per_block):
    rows = odd_rows()
    got = shard_documents(frame(spark, rows), 8, rows_per_block=per_block).collect()
    assert len(got) == len(rows)
    expected = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(i, 8), jump(i, 9)) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == expected
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert all(r.grown_shard in (r.shard, 8) and r.law == "key" for r in got)


def test_empty_and_files(spark, tmp_path):
    assert shard_documents(frame(spark, [])).count() == 0
    write_shards(frame(spark, odd_rows()).drop("shard"), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(back) == 12 and all(r.shard == jump(r.doc_id, 4) for r in back)


def test_5000_copies_of_a_row(spark):
    rows = [(7, "often", "en", "a")] * 5000 + [(None, f"no key {i}", "en", "a") for i in range(500)]
    got = shard_documents(frame(spark, rows), 8, rows_per_block=100).collect()
    assert len(got) == 5500
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
