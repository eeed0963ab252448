"""Token ids of all documents as raw binary payloads, and a minimal perfect hash index for access by key.

A store is a folder of three Parquet tables, so that any file system Spark can reach will do:

* ``payload``: one row per block of whole documents in ascending key order: the ids of its documents one after the other
  (little-endian unsigned 32-bit), their keys and their numbers of ids. A folder per shard, a row group per block: what one
  block holds can be read without any other.
* ``manifest``: for each block its first row and first id, counted over the whole store.
* ``index``: one row per index bucket: a minimal perfect hash of the bucket's distinct keys and, in the order of their
  numbers, a stored fingerprint, the store's row of the key's first document, how many documents have the key, and
  shard, block, place in the block, id offset and length of the first. A lookup costs one hash and one comparison.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablehaul.llm import perfect_hash
from tablehaul.llm.common import blocks_for, in_slices, mapped, saved, ship
from tablehaul.llm.tokens import tokenizer_path, word_ids

_ENTRY = np.dtype([("fingerprint", "<u4"), ("row", "<u8"), ("repeats", "<u4"), ("shard", "<u4"), ("block", "<u4"),
                   ("place", "<u4"), ("offset", "<u8"), ("length", "<u8")])
_PAYLOAD = "shard int, block int, n_docs long, n_ids long, payload binary, keys binary, no_key binary, lengths binary"
_DOCS = "shard int, block int, place int, key long, offset long, length long"


def _encode(path: str, end_id: int, block_bytes: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        ids_of, shard, block = word_ids(path), TaskContext.get().partitionId(), 0
        parts, keys, lengths, held = [], [], [], 0

        def flush():
            nulls = np.array([k is None for k in keys])
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                "n_docs": pa.array([len(keys)], pa.int64()), "n_ids": pa.array([held // 4], pa.int64()),
                "payload": pa.array([b"".join(parts)], pa.binary()),
                "keys": pa.array([np.array([k or 0 for k in keys], "<i8").tobytes()], pa.binary()),
                "no_key": pa.array([np.packbits(nulls).tobytes()], pa.binary()),
                "lengths": pa.array([np.array(lengths, "<i8").tobytes()], pa.binary())})

        for key, text in in_slices(batches):
            ids = ids_of.text(text or b"") + end
            parts.append(ids)
            keys.append(key)
            lengths.append(len(ids) // 4)
            held += len(ids)
            if held >= block_bytes:
                yield flush()
                parts, keys, lengths, held, block = [], [], [], 0, block + 1
        if keys:
            yield flush()

    return run


def _documents(batches):
    """The documents that a block's directory lists; does not touch the payload."""
    for batch in batches:
        for row in batch.to_pylist():
            lengths, n = np.frombuffer(row["lengths"], "<i8"), row["n_docs"]
            nulls = np.unpackbits(np.frombuffer(row["no_key"], np.uint8))[:n].astype(bool)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(np.full(n, row["shard"], np.int32)), "block": pa.array(np.full(n, row["block"], np.int32)),
                "place": pa.array(np.arange(n, dtype=np.int32)),
                "key": pa.array(np.frombuffer(row["keys"], "<i8"), mask=nulls),
                "offset": pa.array(np.cumsum(lengths) - lengths), "length": pa.array(lengths)})


def _index(key: tuple, table: pa.Table, buckets: int) -> pa.Table:
    column = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("key", "bucket")}
    keys = column["hash"].astype(np.int64).view(np.uint64)
    sizes, bits, left = perfect_hash.build(keys)
    numbers = perfect_hash.Reader(sizes, bits, left).number(keys)
    entries = np.zeros(len(keys), _ENTRY)
    entries["fingerprint"][numbers] = perfect_hash.fingerprints(keys)
    for name in _ENTRY.names[1:]:
        entries[name][numbers] = column[name]
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "buckets": pa.array([buckets], pa.int32()),
                     "sizes": pa.array([sizes.tobytes()], pa.binary()), "bits": pa.array([bits], pa.binary()),
                     "left_over": pa.array([left.tobytes()], pa.binary()),
                     "entries": pa.array([entries.tobytes()], pa.binary())})


def _payload(spark: SparkSession, path: str) -> DataFrame:
    kept = [f for f in _PAYLOAD.split(", ") if f != "shard int"]
    return spark.read.schema(", ".join([*kept, "shard int"])).parquet(f"{path}/payload")


def _bucket(key, buckets: int):
    """Null keys have a bucket of their own, as their hash may equal that of a number."""
    return F.when(key.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("int")


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, key: str = "doc_id",
                text: str = "text", rows_per_shard: int = 8192, block_bytes: int = 1 << 20,
                keys_per_bucket: int = 50_000) -> None:
    """Encode whole texts and write a store below ``path``, which must not exist yet.

    Documents lie in ascending key order, null keys first; those that share a key lie together, in order of their texts' hashes, over
    as many shards as they need. Null texts count as empty: their ids are the end id alone. Texts of any length are encoded
    whole, repeated rows are documents like others. An empty table gives an empty store. Only ``key`` and ``text`` are read.
    """
    spark, rows = docs.sparkSession, docs.select(key).count()
    place = [F.col("key").asc_nulls_first(), F.col("hash"), F.col("turn")]
    ordered = (docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"), F.xxhash64(text).alias("hash"),
                           F.monotonically_increasing_id().alias("turn"))
               .repartitionByRange(blocks_for(rows, rows_per_shard), *place).sortWithinPartitions(*place).select("key", "text"))
    mapped(ordered, _encode(tokenizer or tokenizer_path(), end_id, block_bytes), _PAYLOAD).write.option(
        "compression", "zstd").option("parquet.block.row.count.limit", "1").partitionBy("shard").parquet(f"{path}/payload")

    blocks = _payload(spark, path).select("shard", "block", "n_docs", "n_ids")
    order = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_docs").alias("docs"), F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    starts = shards.select("shard", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before")
                                      for c in ("docs", "ids")])
    inside = blocks.select("shard", "block", *[F.coalesce(F.sum(c).over(order), F.lit(0)).alias(c)
                                               for c in ("n_docs", "n_ids")])
    inside.join(starts, "shard").select(
        "shard", "block", (F.col("docs_before") + F.col("n_docs")).alias("first_row"),
        (F.col("ids_before") + F.col("n_ids")).alias("first_id")).write.parquet(f"{path}/manifest")

    directory = _payload(spark, path).select("shard", "block", "n_docs", "keys", "no_key", "lengths")
    listed = mapped(directory, _documents, _DOCS).join(spark.read.parquet(f"{path}/manifest"), ["shard", "block"])
    first = F.struct((F.col("first_row") + F.col("place")).alias("row"), "shard", "block", "place", "offset", "length")
    buckets = blocks_for(rows, keys_per_bucket)
    (listed.groupBy("key").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("repeats"))
     .select("key", F.xxhash64("key").alias("hash"), _bucket(F.col("key"), buckets).alias("bucket"), "repeats",
             "first.*")
     .groupBy("bucket").applyInArrow(lambda key, rows: _index(key, rows, buckets),
                                     "bucket int, buckets int, sizes binary, bits binary, left_over binary, entries binary").write.parquet(f"{path}/index"))


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Where the documents of each distinct key of the one-column frame ``keys`` lie; keys the store lacks give no row.

    Returns key, row, repeats, shard, block, place, offset, length. A key that is absent is taken for another with a
    chance of 2**-32, by its fingerprint.
    """
    index = spark.read.parquet(f"{path}/index")
    buckets = index.agg(F.max("buckets")).first()[0] or 1
    wanted = keys.toDF("key").select(F.col("key").cast("long").alias("key")).distinct()
    wanted = wanted.select("key", F.xxhash64("key").alias("hash"), _bucket(F.col("key"), buckets).alias("bucket"))

    def find(group: pa.Table, entry: pa.Table) -> pa.Table:
        schema = pa.schema([("key", pa.int64()), *[(n, pa.int64()) for n in _ENTRY.names[1:]]])
        if not len(group) or not len(entry):
            return schema.empty_table()
        row = entry.to_pylist()[0]
        hashes = group.column("hash").to_numpy().astype(np.int64).view(np.uint64)
        reader = perfect_hash.Reader(np.frombuffer(row["sizes"], "<u4"), row["bits"],
                                     np.frombuffer(row["left_over"], np.uint64))
        numbers, entries = reader.number(hashes), np.frombuffer(row["entries"], _ENTRY)
        found = np.flatnonzero(numbers >= 0)
        found = found[entries["fingerprint"][numbers[found]] == perfect_hash.fingerprints(hashes[found])]
        got = entries[numbers[found]]
        return pa.table([group.column("key").take(pa.array(found)).combine_chunks(),
                         *[pa.array(got[n].astype(np.int64)) for n in _ENTRY.names[1:]]], schema=schema)

    ship(spark)
    return wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(
        find, "key long, " + ", ".join(f"{n} long" for n in _ENTRY.names[1:]))


def _checksums(batches):
    for batch in batches:
        for row in batch.to_pylist():
            lengths, payload = np.frombuffer(row["lengths"], "<i8"), memoryview(row["payload"])
            ends = 4 * np.cumsum(lengths)
            crc = [zlib.crc32(payload[e - 4 * n:e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(np.full(len(lengths), row["shard"], np.int32)),
                "block": pa.array(np.full(len(lengths), row["block"], np.int32)),
                "place": pa.array(np.arange(len(lengths), dtype=np.int32)),
                "offset": pa.array(np.cumsum(lengths) - lengths), "n_tokens": pa.array(lengths),
                "ids_crc32": pa.array(crc, pa.int64())})


def read_digests(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Of each document whose key is in ``keys``, found by the index: key, start, n_tokens, and ids_crc32 of the payload
    as it is read back. The payload is read once, block by block, and never shuffled. Null keys are keys, repeated keys in ``keys``
    count once, keys that the store lacks give no row; all documents of a key are returned."""
    found = lookup(spark, path, keys).select(
        "key", F.explode(F.sequence(F.col("row"), F.col("row") + F.col("repeats") - 1)).alias("row"))
    payload = _payload(spark, path).select("shard", "block", "payload", "lengths")
    digest = "shard int, block int, place int, offset long, n_tokens long, ids_crc32 long"
    stored = (mapped(payload, _checksums, digest)
              .join(spark.read.parquet(f"{path}/manifest"), ["shard", "block"])
              .select((F.col("first_row") + F.col("place")).alias("row"),
                      (F.col("first_id") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))
    return found.join(stored, "row").select("key", "start", "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, keys: DataFrame, most_blocks: int = 10_000) -> DataFrame:
    """key and the ids (array<long>) of the first document of each of the wanted distinct keys; absent keys give no row.

    The index names the blocks. Up to ``most_blocks`` of them are named to the scan in turn, which opens their shards' folders and reads
    their row groups only; keys in more blocks than that are found by a join over the whole payload.
    """
    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["payload"], "<u4")
                many = [(e["key"], ids[e["offset"]:e["offset"] + e["length"]].astype(np.int64)) for e in row["entries"]]
                yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in many], pa.int64()),
                                                  "ids": pa.array([i for _, i in many], pa.list_(pa.int64()))})

    found = saved(lookup(spark, path, keys).withColumns({c: F.col(c).cast("int") for c in ("shard", "block")}), "found")
    payload = _payload(spark, path).select("shard", "block", "payload")
    named = found.select("shard", "block").distinct().limit(most_blocks + 1).collect()
    if len(named) <= most_blocks:
        payload = payload.where(F.col("shard").isin(sorted({r["shard"] for r in named})) & F.col("block").isin(sorted({r["block"] for r in named})))
    # A block meets its keys some thousands at a time; so many copies of it are made.
    turn = F.pmod(F.xxhash64("key"), F.lit(16)).alias("turn")
    asked = found.groupBy("shard", "block", turn).agg(F.collect_list(F.struct("key", "offset", "length")).alias("entries"))
    return mapped(payload.join(asked, ["shard", "block"]).select("payload", "entries"), cut, "key long, ids array<long>")
