"""A Bloom filter of keys in DataFrame functions: built by aggregates, asked where rows are scanned.

Rows that no key can match are told apart before any shuffle. The filter has at most ``MOST_BITS`` bits whatever the number of keys;
as it fills up, it lets more rows through and never loses one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key, places a key sets, and the size of the largest filter (1 MB).
BITS_PER_KEY, PLACES, MOST_BITS = 10, 4, 1 << 23


def _places(columns: Sequence[Column], bits: int) -> Column:
    first, second = (F.xxhash64(F.lit(turn), *columns) for turn in (1, 2))
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), first, second), F.lit(bits)) for i in range(PLACES)])


def bloom_filter(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """A frame of one row with one column, the filter's words of 64 bits, for about ``n`` keys (all columns), and its number of bits."""
    bits = 64
    while bits < min(n * BITS_PER_KEY, MOST_BITS):
        bits *= 2
    place = keys.select(F.explode(_places([F.col(c) for c in keys.columns], bits)).alias("place"))
    held = place.select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, int(place & 63))").alias("bits"))
    every = keys.sparkSession.range(0, bits // 64, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = held.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("bloom")), bits


def might_hold(bloom: DataFrame, bits: int, columns: Sequence[Column]) -> Column:
    """False for rows whose values are certainly none of the keys; never null. The filter is worked out once and sent along."""
    words = bloom.scalar()
    hit = F.lit(True)
    first, second = (F.xxhash64(F.lit(turn), *columns) for turn in (1, 2))
    for i in range(PLACES):
        place = F.pmod(F.xxhash64(F.lit(i), first, second), F.lit(bits))
        hit = hit & (F.getbit(F.coalesce(F.get(words, F.shiftright(place, 6).cast("int")), F.lit(-1).cast("long")), place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return F.coalesce(hit, F.lit(True))
