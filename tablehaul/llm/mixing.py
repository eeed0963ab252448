"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents are dealt by hash into blocks of bounded size, which is a random order already. A source's target
says how often all of its blocks are taken and how many more of them, counted in words; one block, the one at the edge,
is taken in part, by whole documents. The exact block quotas are then split over the output shards: a binary tree
draws, at every node, how many of each source's blocks go left, as drawing without replacement would. Each shard gets the
next blocks of every source's permuted order, so shards are disjoint, and is shuffled within itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tablehaul.llm.common import n_words, saved, ship, text_hash, told_apart

#: Sources beyond this number need weights of their own kind; their sizes come to the driver.
MOST_SOURCES = 100_000


@dataclass(frozen=True)
class Source:
    number: int
    name: str | None
    words: int
    rows: int
    target: float


def targets(sizes: list[int], weights: list[float], most_times: float) -> list[float]:
    """Shares of all words by weight; what exceeds ``most_times`` a source's size is shared again among the others."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > most_times * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(most_times * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """``shards`` rows of quotas per source that sum to ``quotas``; shard totals differ by at most one."""
    out, rng = np.zeros((shards, len(quotas)), np.int64), np.random.default_rng(seed)
    ends = np.array([int(quotas.sum()) * k // shards for k in range(shards + 1)])

    def down(low: int, high: int, mine: np.ndarray) -> None:
        if high - low == 1:
            out[low] = mine
            return
        middle = (low + high) // 2
        left = rng.multivariate_hypergeometric(mine, int(ends[middle] - ends[low]), method="marginals")
        down(low, middle, left)
        down(middle, high, mine - left)

    down(0, shards, quotas.astype(np.int64))
    return out


def measured(docs: DataFrame, seed: int, block_docs: int, most_times: int, key: str, text: str, source: str, row: Column):
    """The rows with their sizes and blocks, and the sources with their targets. Rows that repeat are numbered, so that each has
    a block of its own; ``row`` tells rows apart that have the same key, text and source."""
    named = docs.select(F.col(key).alias("key"), text_hash(text), n_words(F.col(text)).alias("size"),
                        F.col(source).cast("string").alias("source"), row.alias("row"))
    rows = saved(told_apart(named, "repeat"), "sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).limit(
        MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["words"] for r in found], [1.0 + i % 3 for i in range(len(found))], most_times)
    sources = [Source(i, r["source"], r["words"], r["n"], t) for i, (r, t) in enumerate(zip(found, wanted, strict=True))]
    known = docs.sparkSession.createDataFrame(
        [(s.number, s.name, s.words, s.target, max(1, -(-s.rows // block_docs))) for s in sources],
        "number int, name string, source_size long, target double, blocks long")
    def drawn(turn: int) -> Column:
        first = F.xxhash64(F.lit(turn), "key", "text_hash")
        return F.when(F.col("repeat") == 0, first).otherwise(F.xxhash64(first, "repeat"))

    dealt = rows.join(F.broadcast(known), rows["source"].eqNullSafe(known["name"])).select(
        "key", "text_hash", "row", "repeat", "size", "number", "source_size", "target", "blocks",
        F.pmod(drawn(seed), F.col("blocks")).alias("block"), drawn(seed + 1).alias("turn"))
    return saved(dealt, "dealt"), sources


def fill(sizes: list[int], room: int) -> list[int]:
    """Which of ``sizes`` (1 or 0 each) come nearest to ``room`` in sum: those in front while much is left, then the best
    subset of the others, found on a bit set of reachable sums (in steps of 1/2**17 of the largest size)."""
    most = max(sizes, default=0)
    took, at = [0] * len(sizes), 0
    while at < len(sizes) and room - sizes[at] >= 4 * most:
        took[at], room, at = 1, room - sizes[at], at + 1
    unit = max(1, most >> 17)
    goal, steps = room // unit, [s // unit for s in sizes[at:]]
    reach, mask = [1], (1 << (goal + most // unit + 1)) - 1
    for s in steps:
        reach.append((reach[-1] | reach[-1] << s) & mask)
    below = (reach[-1] & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = reach[-1] >> (goal + 1)
    above = goal + 1 + (above & -above).bit_length() - 1 if above else below
    best = above if above - goal < goal - below else below
    for i in range(len(steps) - 1, -1, -1):
        if not reach[i] >> best & 1:
            took[at + i], best = 1, best - steps[i]
    return took


def _fill(block: pa.Table) -> pa.Table:
    """Which rows of the block at a source's edge are taken, in their random turn."""
    block = block.sort_by([(c, "ascending") for c in ("turn", "key", "text_hash", "row", "repeat", "size")])
    more = fill(block.column("size").to_pylist(), block.column("room")[0].as_py())
    return block.append_column("more", pa.array(more, pa.int32()))


def mix(docs: DataFrame, shards: int = 16, seed: int = 7, block_docs: int = 256, most_times: int = 3, key: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """``key``, text_hash, repeat, size, source_size, target, copies, taken (words, repeats counted) and shards (one per copy).

    Sources weigh 1, 2, 3, repeating, in code-point order, null last, and share as many words as there are; none gets more
    than ``most_times`` its own. Every row is taken as a whole, between 0 and ``most_times`` times; a source's words
    come as near its target as whole rows of its block at the edge allow. A null text has size 0, and rows of size 0 are
    taken like the block they lie in. Null keys and repeated rows (numbered by ``repeat``) are rows like others; texts of any length
    are counted whole; an empty table gives no rows; other columns are not read. The same rows give the same mix, in
    whatever order they come.
    """
    plan = _mixed(docs, shards, seed, block_docs, most_times, key, text, source, F.lit(0).cast("long"))
    return plan.withColumnRenamed("key", key).drop("row")


def _mixed(docs: DataFrame, shards: int, seed: int, block_docs: int, most_times: int, key: str, text: str, source: str, row: Column) -> DataFrame:
    rows, sources = measured(docs, seed, block_docs, most_times, key, text, source, row)
    # Words of each block, and those of the source's blocks before it; the blocks' sums are added up in two levels.
    blocks = rows.groupBy("number", "block", "source_size", "target").agg(F.sum("size").alias("words"))
    blocks = blocks.withColumn("stretch", F.floor(F.col("block") / 1024))
    earlier = Window.partitionBy("number").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("number", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stretches = blocks.groupBy("number", "stretch").agg(F.sum("words").alias("w")).select(
        "number", "stretch", F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("base"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - F.col("passes") * F.col("source_size"))
    blocks = saved(
        blocks.join(stretches, ["number", "stretch"]).withColumn("passes", full.cast("long"))
        .withColumn("room", rest - F.col("base") - F.coalesce(F.sum("words").over(inside), F.lit(0)))
        .select("number", "block", "words", "passes", "room",
                F.when((F.col("room") > 0) & (F.col("words") <= F.col("room")), 2).when(F.col("room") > 0, 1).otherwise(0)
                .alias("extra")), "blocks")
    # room: words still wanted when the block's turn comes; extra: 2 whole block, 1 block at the edge, 0 none
    counts = {r["number"]: r for r in blocks.groupBy("number").agg(
        F.max("passes").alias("passes"),
        F.coalesce(F.max(F.when(F.col("extra") > 0, F.col("block") + 1)), F.lit(0)).alias("more")).collect()}  # one row per source
    size = [max(1, -(-s.rows // block_docs)) for s in sources]
    quotas = np.array([size[s.number] * counts[s.number]["passes"] + counts[s.number]["more"] if s.number in counts else 0
                       for s in sources], np.int64)
    parts = split_quotas(quotas, shards, seed) if len(sources) else np.zeros((shards, 0), np.int64)
    ends = np.cumsum(parts, axis=0)
    drawn = docs.sparkSession.createDataFrame(
        [(s.number, size[s.number], [int(x) for x in ends[:, s.number]]) for s in sources],
        "number int, source_blocks long, ends array<long>")

    marked = rows.join(blocks.drop("words"), ["number", "block"])
    at_edge = marked.filter("extra = 1")  # one block per source, of bounded size
    ship(docs.sparkSession)
    edge = at_edge.groupBy("number").applyInArrow(_fill, StructType([*at_edge.schema.fields, StructField("more", IntegerType())]))
    plain = marked.filter("extra != 1").withColumn("more", (F.col("extra") == 2).cast("int"))
    # A copy's number in its source's order: pass by pass, and block by block within a pass. Its shard is the first whose
    # quotas, added up, reach beyond that number.
    taken = plain.unionByName(edge).join(F.broadcast(drawn), "number")
    copies = (F.col("passes") + F.col("more")).cast("int")
    at = F.transform(F.sequence(F.lit(0), F.greatest(copies - 1, F.lit(0))), lambda c: F.size(F.filter(
        "ends", lambda e: e <= c * F.col("source_blocks") + F.col("block"))).cast("int"))
    return taken.select("key", "text_hash", "row", "repeat", "size", "source_size", "target", copies.alias("copies"),
                        (copies * F.col("size")).cast("long").alias("taken"),
                        F.when(copies > 0, at).otherwise(F.array().cast("array<int>")).alias("shards"))


def mixed_documents(docs: DataFrame, shards: int = 16, seed: int = 7, block_docs: int = 256, most_times: int = 3, key: str = "doc_id",
                    text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, unchanged, as often as the mix takes each, dealt to the mix's shards and shuffled there.

    Rows are told apart by all their columns. Those that agree in all are interchangeable: together they appear as often as the mix
    takes them together. Columns may have any names; nulls, empty and very long texts are as in ``mix``; an empty table
    gives no rows.
    """
    whole = [F.to_json(F.struct(c)) if docs.schema[c].dataType.typeName() in ("map", "variant") else F.col(f"`{c}`") for c in docs.columns]
    row = F.xxhash64(*[x for c in whole for x in (c.isNull(), c)])
    rows = docs.select(F.struct("*").alias("doc"), row.alias("row"), text_hash(text))
    plan = _mixed(docs, shards, seed, block_docs, most_times, key, text, source, row).filter("copies > 0").select("row", "text_hash", "repeat", "shards")
    found = rows.dropDuplicates(["row", "text_hash"]).join(plan, ["row", "text_hash"])
    each = found.select("doc", "row", "repeat", F.posexplode("shards").alias("copy", "shard"))
    order = F.xxhash64("shard", "copy", "repeat", "row")
    return each.repartition("shard", F.pmod(order, F.lit(8))).sortWithinPartitions("shard", order).select("doc.*")
