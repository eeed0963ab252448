"""SimHash fingerprints, linked by covering locality-sensitive hashing.

For radius r every bit position gets a non-zero vector of r + 1 bits. Each of the 2**(r+1) - 1 non-zero vectors v then
names a mask: the positions whose vector has an odd inner product with v. Up to r differing positions span at most r of
the r + 1 dimensions, so some v is orthogonal to them all: under its mask the two fingerprints are equal. Every
pair within the radius meets in at least one table (Pagh, "CoveringLSH", 2016); none is missed.

Fingerprints are made distinct first. A bucket with more than ``bucket_limit`` of them is covered again over the bits
that its mask leaves open, as often as needed. A bucket with ``SMALL`` open bits is at its end: it cannot hold more than
2**SMALL fingerprints.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import mapped, rows_of, saved, text_hash
from tablehaul.llm.components import components

BITS = 64
SMALL = 16
#: The fixed lower-casing of the contract: A to Z only.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a bounded piece at a time, whatever the length of the text
        part = hashes[at:at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > len(hashes)).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprint(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of the word shingles of a whole text, repeats included; 0 without words."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(line[a:b], seed) for a, b in zip((ends - lengths)[:len(words) - width + 1].tolist(),
                                                                  ends[width - 1:].tolist(), strict=True)], np.uint64)
    return majority(hashes)


def _fingerprints(width: int, seed: int):
    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t, width, seed) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(prints.view(np.int64))],
                                             ["key", "text_hash", "print"])

    return run


@lru_cache(maxsize=4096)
def masks(used: int, radius: int) -> tuple[int, ...]:
    """The masks that cover ``radius`` over the bits not in ``used``."""
    vectors = 2 ** (radius + 1) - 1
    open_ = [b for b in range(BITS) if not used >> b & 1]
    at = {b: i % vectors + 1 for i, b in enumerate(open_)}
    return tuple(sum(1 << b for b, m in at.items() if (m & v).bit_count() % 2) for v in range(1, vectors + 1))


def _keys(radius: int):
    """Each fingerprint once per mask over the bits that its bucket's mask has left open, with the wider mask."""
    def run(batches):
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            used = batch.column("used").to_numpy().view(np.uint64)
            for known in np.unique(used):
                mine = prints[used == known]
                wider = np.array([m | int(known) for m in masks(int(known), radius)], np.uint64)
                for at in range(0, len(mine), 2048):
                    part = mine[at:at + 2048]
                    n, k = len(part), len(wider)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(part, k).view(np.int64)), pa.array(np.tile(wider, n).view(np.int64)),
                         pa.array((part[:, None] & wider[None, :]).ravel().view(np.int64))], ["print", "used", "bucket"])

    return run


def forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what the links within ``radius`` connect, found by breadth-first search: every fingerprint
    is compared with those not reached yet."""
    waiting, edges = prints, []
    while len(waiting) > 1:
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            here = front.pop()
            near = np.bitwise_count(waiting ^ here) <= radius
            if near.any():
                reached = waiting[near]
                front.extend(reached)
                edges.extend((int(here), int(x)) for x in reached)
                waiting = waiting[~near]
    return edges


def _edges(radius: int):
    def run(batches):
        for batch in batches:
            column = batch.column(0)
            flat, ends = column.flatten().to_numpy().view(np.uint64), column.offsets.to_numpy()
            ends = ends - ends[0]
            found = [e for a, b in zip(ends[:-1], ends[1:], strict=True) for e in forest(flat[a:b], radius)]
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def links(prints: DataFrame, radius: int = 4, bucket_limit: int = 4096) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``print``, long) whose components are those of all links."""
    level, found = prints.select("print", F.lit(0).cast("long").alias("used")), None
    while True:
        dealt = mapped(level, _keys(radius), "print long, used long, bucket long")
        heavy = saved(dealt.groupBy("used", "bucket").agg(F.count(F.lit(1)).alias("n")).filter(
            (F.col("n") > bucket_limit) & (BITS - F.bit_count("used") > SMALL)).select("used", "bucket"), "heavy")
        crowded = not heavy.isEmpty()
        light = dealt.join(heavy, ["used", "bucket"], "left_anti") if crowded else dealt
        groups = light.groupBy("used", "bucket").agg(F.collect_list("print").alias("prints")).filter("size(prints) > 1")
        edges = mapped(groups.select("prints"), _edges(radius), "a long, b long")
        found = edges if found is None else found.unionByName(edges)
        if not crowded:
            return found
        level = saved(dealt.join(heavy, ["used", "bucket"], "left_semi").select("print", "used"), "crowded")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4, seed: int = 42, key: str = "doc_id",
                    text: str = "text", bucket_limit: int = 4096) -> DataFrame:
    """``key``, fingerprint (16 lower-case hex digits), component_id (the smallest key reachable over links), the text's
    hash, and whether the row is the first of its component, for every row.

    Two rows are linked when their fingerprints differ in at most ``radius`` bits. Null and wordless texts have fingerprint
    zero and are linked like others; texts of any length are read whole. Rows with a null key have a fingerprint and their component's smallest key, which is
    null only if no row of the component has one. Repeated rows give repeated rows; an empty table gives none; other
    columns are not read. The first row of a component has the smallest key and then text hash; rows that repeat it
    are first, too.
    """
    texts = docs.select(F.col(key).cast("long").alias("key"), text_hash(text), F.col(text).cast("binary").alias("text"))
    rows = saved(mapped(texts, _fingerprints(width, seed), "key long, text_hash long, print long"), "fingerprints")
    place = F.struct(F.col("key").isNull().alias("last"), "key", "text_hash")
    classes = saved(rows.groupBy("print").agg(F.min(place).alias("first")), "classes")
    rooted = components(links(classes, radius, bucket_limit))
    joined = saved(classes.join(rooted, classes["print"] == rooted["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")), "classes")
    firsts = joined.groupBy("root").agg(F.min("first").alias("first"))
    names = joined.select("print", "root").join(firsts, "root").select("print", F.col("first").alias("_first"))
    return rows.join(names, "print").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("_first.key").alias("component_id"), "text_hash", (place == F.col("_first")).alias("is_first"))


def keep_one(docs: DataFrame, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, the first, with all its columns; of rows that repeat it, one."""
    firsts = near_duplicates(docs, radius, key=key, text=text).filter("is_first")
    return rows_of(docs, firsts, key, text).dropDuplicates([key, text])
