import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablehaul.llm import perfect_hash
from tablehaul.llm.common import numbered, told_apart
from tablehaul.llm.packing import best_fit, best_pattern, generate_columns, pack, pieces, plan, sequences, assign
from tablehaul.llm.token_files import lookup, read_digests, read_ids, write_store
from tablehaul.llm.tokens import WordIds, tokenizer_path
from tests.llm.helpers import frame, odd_rows


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text, end: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_word_by_word_equals_the_library(library):
    words = WordIds(tokenizer_path())
    odd = ["İstanbul ŉ naïve it's I'LL don't 'sS ##12'3 a'd", "Ｆｕｌｌ ΣΑΣ Σ", "e\u0301 \u0301x <|endoftext|>x a<|startoftext|>b\x1cq\x85z",
           "ª º µ × ÷ ßẞ straßE", "A" * 500 + "!!" + "1" * 300, "x\x00y", "Ǆ ǅ ﬁ", "a..b,, c;:", *[t or "" for _, t, *_ in odd_rows()]]
    for text in odd:
        assert words.text(text.encode()) == library(text, 0)[:-1].tobytes()


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(2**62, n, replace=False).astype(np.uint64)
    reader = perfect_hash.Reader(*perfect_hash.build(keys))
    assert sorted(reader.number(keys).tolist()) == list(range(n))
    reader.number(np.arange(50, dtype=np.uint64))  # strangers get any number or none


@pytest.mark.parametrize("sizes", [{"rows_per_shard": 8192}, {"rows_per_shard": 3, "block_bytes": 4000, "keys_per_bucket": 4}])
def test_store_round_trip(spark, tmp_path, library, sizes):
    docs, path = frame(spark, odd_rows()), str(tmp_path / "store")
    write_store(docs, path, **sizes)
    got = sorted(read_digests(spark, path, docs.select("doc_id")).collect(), key=lambda r: r.start)
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for (key, text, *_), r in zip(rows, got, strict=True):
        ids = library(text, 2)
        assert (r.key, r.start, r.n_tokens, r.ids_crc32) == (key, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    wanted = spark.createDataFrame([(9,), (4,), (9,), (12345,), (None,)], "k long")
    found = {r.key: r for r in lookup(spark, path, wanted).collect()}
    assert set(found) == {9, 4, None}
    assert {r.key: r.ids for r in read_ids(spark, path, wanted).collect()} == {
        k: library(t, 2).tolist() for k, t, *_ in rows if k in (9, 4, None)}


def test_empty_store(spark, tmp_path):
    docs, path = frame(spark, []), str(tmp_path / "store")
    write_store(docs, path)
    assert read_digests(spark, path, docs.select("doc_id")).count() == 0


def test_knapsack_and_plan():
    rng = np.random.default_rng(0)
    for capacity in (5, 12, 20):
        values = rng.random(capacity)
        best = [0.0] * (capacity + 1)
        for room in range(1, capacity + 1):
            best[room] = max(best[room - 1], *(best[room - n] + values[n - 1] for n in range(1, room + 1)))
        value, pattern = best_pattern(values, capacity)
        assert abs(value - best[capacity]) < 1e-9 and (pattern * np.arange(1, capacity + 1)).sum() <= capacity
        assert abs((pattern * values).sum() - value) < 1e-9
    for n in (0, 3, 40, 5000):
        demand = np.bincount(rng.integers(0, 64, n), minlength=64)
        chosen = plan(demand, 64)
        assert (sum((p * t for p, t in chosen), np.zeros(64, int)) == demand).all()
        assert all((p * np.arange(1, 65)).sum() <= 64 for p, _ in chosen)
    least = (demand * np.arange(1, 65)).sum() / 64
    assert sum(x for _, x in generate_columns(demand, 64)) < 1.01 * least + 1 and sum(t for _, t in chosen) < 1.02 * least + 4
    assert [p.tolist() for p in best_fit(np.array([1, 0, 1]), 4)] == [[1, 0, 1]]


def test_pack(spark, library):
    rows = odd_rows() + [(100 + i, f"word{i} " * (i * 7), "en", "a") for i in range(60)]
    got = pack(frame(spark, rows)).collect()
    ids = {}
    for key, text, *_ in rows:
        ids.setdefault(key, library(text, 1))
    seen = {}
    for r in got:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {k: len(v) * sum(k == i for i, *_ in rows) for k, v in ids.items()}
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    padding = total = 0
    for parts in by.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total, padding = total + at, padding + (0 if at & (at - 1) == 0 else 2048 - at)
    assert padding < 0.05 * total
    assert pack(frame(spark, [])).count() == 0


def test_sequences_hold_the_ids(spark, library):
    rows = [(i, f"some words {i} " * (200 * i), "en", "a") for i in range(1, 6)]
    cut = pieces(frame(spark, rows), context=512).cache()
    made = {r.sequence_id: r.ids for r in sequences(assign(cut, context=512)).collect()}
    placed = assign(cut, context=512).select("key", "start", "length", "sequence_id", "offset").collect()
    for r in placed:
        assert made[r.sequence_id][r.offset:r.offset + r.length] == library(rows[r.key - 1][1], 1)[r.start:r.start + r.length].tolist()
    assert sum(map(len, made.values())) == sum(r.length for r in placed)


def test_5000_copies_of_a_row(spark, tmp_path, library):
    rows = [(7, "one row that is here very often", "en", "a")] * 5000 + [(i, f"row {i} of its own", "en", "a") for i in range(20)] + [(None, f"no key {i % 3}", "en", "a") for i in range(300)]
    docs, path = frame(spark, rows), str(tmp_path / "store")
    write_store(docs, path, rows_per_shard=500, block_bytes=4000)
    got = sorted(read_digests(spark, path, docs.select("doc_id")).collect(), key=lambda r: r.start)
    assert len(got) == len(rows) and got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    assert sorted(str((r.key, r.ids_crc32)) for r in got) == sorted(str((i, zlib.crc32(library(t, 2).tobytes()))) for i, t, *_ in rows)
    shards = spark.read.parquet(f"{path}/payload").groupBy("shard").agg(F.sum("n_docs").alias("n")).collect()
    assert max(r.n for r in shards) < 1500  # the copies lie in several shards
    packed = pack(docs).collect()
    assert len(packed) == len(rows) and len({(r.sequence_id, r.offset) for r in packed}) == len(rows)


def test_numbering_deals_copies_to_blocks(spark):
    rows = spark.createDataFrame([(1, 7)] * 5000 + [(2, i) for i in range(100)], "k int, v int")
    apart = told_apart(rows, "_repeat", chunk=64)
    assert apart.where("v = 7 AND k = 1").agg(F.min("_repeat"), F.max("_repeat"), F.count_distinct("_repeat")).first()[:] == (0, 4999, 5000)
    got = numbered(apart, ["k"], ["v", "_repeat"], 5100, "n", rows_per_block=50).collect()
    for k, n in ((1, 5000), (2, 100)):
        assert sorted(r.n for r in got if r.k == k) == list(range(n))


def test_one_key_reads_one_block(spark, tmp_path, library):
    rows = [(i, f"text number {i} " + "of some words " * 200, "en", "a") for i in range(400)]
    path = str(tmp_path / "store")
    write_store(frame(spark, rows), path, rows_per_shard=100, block_bytes=8000)
    assert spark.read.parquet(f"{path}/payload").count() > 60
    got = read_ids(spark, path, spark.createDataFrame([(123,)], "k long"))
    assert got.collect()[0].ids == library(rows[123][1], 2).tolist()
    nodes = [got._jdf.queryExecution().executedPlan()]
    scans = []
    while nodes:
        node = nodes.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        if "payload:binary" in node.toString() and node.nodeName().startswith("Scan"):
            scans.append({m: node.metrics().apply(m).value() for m in ("numFiles", "numOutputRows")})
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert scans == [{"numFiles": 1, "numOutputRows": 1}]
    # Keys in more blocks than are named to the scan are found by a join.
    some = spark.createDataFrame([(i,) for i in range(0, 400, 7)], "k long")
    want = {i: library(rows[i][1], 2).tolist() for i in range(0, 400, 7)}
    assert {r.key: r.ids for r in read_ids(spark, path, some, most_blocks=3).collect()} == want == {r.key: r.ids for r in read_ids(spark, path, some).collect()}
