"""Sharding by jump consistent hashing, in DataFrame functions only.

A row's shard depends on its key and the number of shards; no table of ring positions exists. When one shard is
appended, a row either stays or moves to the new shard, which happens to 1/(n+1) of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import numbered, saved, told_apart

# Fixed values of the published jump consistent hash (Lamping and Veach, 2014): the multiplier of its 64-bit linear
# congruential generator, here as three limbs of 24, 24 and 16 bits, so that no product overflows a long.
MULTIPLIER = 2862933555777941757
_LIMBS = (MULTIPLIER & 0xFFFFFF, MULTIPLIER >> 24 & 0xFFFFFF, MULTIPLIER >> 48)
#: Steps taken between two looks at whether the walk has ended.
_STRIDE = 16


def _next_key(s: Column) -> tuple[Column, Column, Column]:
    """key * MULTIPLIER + 1 modulo 2**64, on limbs."""
    a0, a1, a2 = (F.lit(x).cast("long") for x in _LIMBS)
    low = s["k0"] * a0 + 1
    middle = F.shiftright(low, 24) + s["k0"] * a1 + s["k1"] * a0
    high = F.shiftright(middle, 24) + s["k0"] * a2 + s["k1"] * a1 + s["k2"] * a0
    return low.bitwiseAND(F.lit(0xFFFFFF)), middle.bitwiseAND(F.lit(0xFFFFFF)), high.bitwiseAND(F.lit(0xFFFF))


def _step(s: Column, shards: Column) -> Column:
    k0, k1, k2 = _next_key(s)
    top = F.shiftleft(k2, 15).bitwiseOR(F.shiftright(k1, 9))  # key >> 33
    jump = ((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (top + 1).cast("double"))).cast("long")
    moved = F.struct(s["j"].alias("b"), jump.alias("j"), k0.alias("k0"), k1.alias("k1"), k2.alias("k2"))
    return F.when(s["j"] < shards, moved).otherwise(s)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (int, 0 to ``shards`` - 1) of a long key. A null key has a shard like any other: that of key -1.

    Every step of the walk moves at least one shard on, so ``shards`` steps always suffice; once a walk has ended, whole
    strides of steps are passed over.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    key = F.coalesce(key.cast("long"), F.lit(-1).cast("long"))
    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
                     key.bitwiseAND(F.lit(0xFFFFFF)).alias("k0"),
                     F.shiftrightunsigned(key, 24).bitwiseAND(F.lit(0xFFFFFF)).alias("k1"),
                     F.shiftrightunsigned(key, 48).alias("k2"))
    n = F.lit(shards).cast("long")

    def stride(s: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, _STRIDE))), s, lambda t, _: _step(t, n))

    whole = (shards + _STRIDE - 1) // _STRIDE
    end = stride(start) if whole == 1 else F.aggregate(
        F.sequence(F.lit(1), F.lit(whole)), start, lambda s, _: F.when(s["j"] < n, stride(s)).otherwise(s))
    return end["b"].cast("int")


def shard_documents(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text",
                    rows_per_block: int = 50_000) -> DataFrame:
    """Every row's shard, its slot there, and the shard it would have with one shard more.

    Returns ``key``, size (UTF-8 bytes of the text plus 1), text_crc32, law (``key``), shard, slot (long, 0 up to the
    shard's rows - 1), grown_shard. Null texts count as empty; null keys all share one shard; rows that repeat have a slot
    each; other columns are not looked at; an empty table gives no rows; texts of any length are measured whole. Equal texts go
    where their own keys send them, so a group of copies of any size is spread over all shards.
    """
    bytes_of = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), (F.octet_length(bytes_of) + 1).cast("long").alias("size"),
                       F.crc32(bytes_of.cast("binary")).alias("text_crc32"))
    rows = saved(told_apart(rows, "_repeat"), "rows")
    keyed = rows.select("*", jump_hash(F.col("_key"), shards).alias("shard"))
    with_slot = numbered(keyed, ["shard"], ["_key", "size", "text_crc32", "_repeat"], rows.count(), "slot", rows_per_block)
    return with_slot.select(F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                            jump_hash(F.col("_key"), shards + 1).alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, key: str = "doc_id", files_per_shard: int = 1) -> None:
    """Write all columns of ``docs`` into one folder ``shard=k`` per shard, each in up to ``files_per_shard`` files.

    Null keys share a shard, rows that repeat are written as often, an empty table gives an empty folder. Rows of one key are
    spread over their shard's files.
    """
    part = F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.lit(files_per_shard))
    (docs.withColumn("shard", jump_hash(F.col(key), shards)).repartition(shards * files_per_shard, "shard", part)
     .write.partitionBy("shard").parquet(path))
