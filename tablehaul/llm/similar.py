"""Near-duplicates by the similarity of word shingles, found by SimHash and prefix filtering; no pair is missed.

A text is the set of its shingles. Sets whose fingerprints (``simhash.py``, over the set's hashes) differ in few bits are found by
covering LSH, as op7 does, and compared. That reaches the closest copies only, so the others are found by prefix filtering. All shingles have one order, rare ones first. Two sets with a similarity (shared shingles by
all shingles of either) of at least t share a shingle among the first n - ceil(t n) + 1 of each, n being the size of the set
(Chaudhuri et al., 2006; Bayardo et al., 2007). So sets are dealt to those shingles, and sets that meet are compared.
The order decides the cost only: it is estimated from an eighth of the texts.

Equal sets are made one first. What is stored of a set is its sketch: how many shingles fall into each of about n classes of
hashes. Sketches that differ by more than sets of that similarity can differ rule a pair out; the sets themselves, made from the texts
again, are compared for the few pairs left. Sets that meet are linked in two steps: each with two of its bucket, and then, of the sets
that are in different components still, each with each. Where that leaves more pairs than a few per set, the sets themselves
meet, and only the edges come out that join their components, fewer than there are sets.

Common shingles are aggregated where they lie, others are dealt to tasks; a bucket of many sets in different components is
cut into blocks, and every two blocks meet in a task of their own.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm import simhash
from tablehaul.llm.common import discard, in_slices, mapped, rows_of, saved, text_hash
from tablehaul.llm.components import components
from tablehaul.llm.simhash import _LOWER, majority

#: How many common shingles come last in the order, and how often a shingle is in an eighth of the sets to be one.
COMMON, OFTEN = 100_000, 4
#: A shingle that one of so many sets has is aggregated before it is dealt; sets of a bucket that meet in one task, from either side.
HOT, BLOCK = 1000, 1024
#: Sets that a task remembers to have dealt; pairs that come out of a group for each of its sets, before the sets themselves meet, and
#: the shingles of sets that do so in one task, from either side.
DEALT, FEW, HELD = 500_000, 2, 500_000
#: Classes in the sketch of a very large set.
CLASSES = 8192
_TURN = 0x5DEECE66D1234567


def shingles(text: bytes | None, width: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text, A to Z in lower case; a text of fewer words is one shingle."""
    words = (text or b"").translate(_LOWER).split()
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[a:b], seed) for a, b in zip(
        (ends - lengths)[:len(words) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True)), np.uint64))


def node_of(hashes: np.ndarray, seed: int = 42) -> int:
    """The name of a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), seed)).view(np.int64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """How many hashes end in each pattern of bits, at most 255: less than one on average, but for very large sets."""
    size = min(CLASSES, 1 << max(4, len(hashes).bit_length()))
    return np.minimum(np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size), 255).astype(np.uint8)


def may_be_alike(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """False only for sets that differ in more shingles than a similarity of ``percent`` % allows."""
    size = min(len(a), len(b))
    a, b = (x.reshape(-1, size).sum(0, dtype=np.int64) for x in (a, b))
    return (100 + percent) * int(np.abs(a - b).sum()) <= (100 - percent) * (n_a + n_b)


def _sketches(width: int, seed: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t, width, seed) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array([node_of(s, seed) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([sketch(s).tobytes() for s in sets], pa.binary()), pa.array(np.array([majority(s) for s in sets], np.uint64).view(np.int64))],
                    ["key", "text_hash", "node", "size", "sketch", "print"])

    return run


def _packed(width: int, seed: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(
                    [shingles(t, width, seed).astype("<u8").tobytes() for t in part.column("text").to_pylist()], pa.binary())], ["node", "shingles"])

    return run


def _flat(width: int, seed: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                every = [shingles(t, width, seed) for t in batch.column("text").slice(at, 256).to_pylist()]
                if every:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(every).view(np.int64))], ["shingle"])

    return run


def prefix(hashes: np.ndarray, common: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, one of which every set of at least that similarity has among its own first ones."""
    n, weight = len(hashes), 0
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        weight = np.where(common[at] == hashes, counts[at], 0)
    order = np.lexsort((hashes, np.broadcast_to(weight, n)))
    return hashes[order[:n + (-percent * n) // 100 + 1]]


def _deal(shared, width: int, seed: int, percent: int):
    """Each set once per shingle of its prefix; sets that the task has dealt lately are left out."""
    def run(batches):
        seen: set[int] = set()
        common, counts, hot = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                firsts, nodes, sizes = [], [], []
                for text in batch.column("text").slice(at, 256).to_pylist():
                    hashes = shingles(text, width, seed)
                    node = node_of(hashes, seed)
                    if node not in seen:
                        if len(seen) >= DEALT:
                            seen.clear()
                        seen.add(node)
                        firsts.append(prefix(hashes, common, counts, percent))
                        nodes.append(node)
                        sizes.append(len(hashes))
                if nodes:
                    many, every = [len(f) for f in firsts], np.concatenate(firsts)
                    place = np.minimum(np.searchsorted(hot, every), max(0, len(hot) - 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(every.view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), many)),
                         pa.array(np.repeat(np.array(sizes, np.int64), many)),
                         pa.array(hot[place] == every if len(hot) else np.zeros(len(every), bool))], ["shingle", "node", "size", "hot"])

    return run


class _Sketches:
    """Sketches of sets in order of their sizes, side by side, folded to as many classes as asked for."""

    def __init__(self, packed: list[bytes]):
        self.all = [np.frombuffer(x, np.uint8) for x in packed]
        self.classes = np.array([len(x) for x in self.all])
        self.folded: dict[int, tuple[int, np.ndarray]] = {}

    def differ(self, i: int, others: np.ndarray) -> np.ndarray:
        """In how many shingles set i and larger ones differ at least."""
        classes = int(self.classes[i])
        if classes not in self.folded:
            first = int(np.searchsorted(self.classes, classes))
            self.folded = {classes: (first, np.stack([x.reshape(-1, classes).sum(0, dtype=np.int32).astype(np.int16) for x in self.all[first:]]))}
        first, rows = self.folded[classes]
        return np.abs(rows[others - first] - rows[i - first]).sum(1, dtype=np.int64)


def _others(percent: int):
    """The pairs of a group that are in different components and, where it holds two blocks, in different blocks, as far as their
    sizes and sketches allow a high similarity; if they are many, the sets that are in one, with ``b`` null, instead."""
    def run(batches):
        for batch in batches:
            for bucket, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                node, size, root, side, packed = (list(c) for c in zip(*[m.values() for m in row.as_py()], strict=True))
                order = np.argsort(np.array(size), kind="stable")
                node, size, root, side = (np.array(c, np.int64)[order] for c in (node, size, root, side))
                sketches = _Sketches([packed[i] for i in order])
                top = np.searchsorted(size, 100 * size // percent, side="right")
                mixed = bool((side != side[0]).any())
                found, held, near = [], 0, np.zeros(len(node), bool)
                for i in range(len(node) - 1):
                    others = np.arange(i + 1, top[i])
                    others = others[root[others] != root[i]]
                    if mixed:
                        others = others[side[others] != side[i]]
                    if len(others):
                        others = others[(100 + percent) * sketches.differ(i, others) <= (100 - percent) * (size[i] + size[others])]
                    if len(others):
                        near[i] = near[others] = True
                        held += len(others)
                        if held <= FEW * len(node):
                            found.append((i, others))
                if held > FEW * len(node):
                    n = int(near.sum())
                    yield pa.RecordBatch.from_arrays([pa.array(node[near]), pa.nulls(n, pa.int64()), pa.array([bucket] * n, pa.int64()),
                                                      pa.array(size[near]), pa.array(root[near])], ["a", "b", "bucket", "size", "root"])
                elif held:
                    one = np.concatenate([np.full(len(others), node[i]) for i, others in found])
                    two, none = node[np.concatenate([others for _, others in found])], pa.nulls(held, pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), none, none, none],
                                                     ["a", "b", "bucket", "size", "root"])

    return run


def joining(node: np.ndarray, root: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges that connect what links between the sets and their components (those of equal ``root``) connect, found by breadth-first
    search: every set is compared with those not reached yet, where there are two sides with those of the other."""
    size = np.array([len(s) for s in sets])
    parts = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(size)[:-1])
    here, mixed = np.zeros(int(size.sum()), np.int64), bool((side != side[0]).any())
    waiting, edges = np.arange(len(sets)), []
    while len(waiting) > 1:
        first = root[waiting] == root[waiting[0]]
        front, waiting = waiting[first].tolist(), waiting[~first]
        while front and len(waiting):
            i = front.pop()
            may = waiting[100 * np.minimum(size[waiting], size[i]) >= percent * np.maximum(size[waiting], size[i])]
            if mixed:
                may = may[side[may] != side[i]]
            if not len(may):
                continue
            here[parts[i]] = 1
            shared = np.add.reduceat(here[np.concatenate([parts[j] for j in may])], np.cumsum(size[may]) - size[may])
            here[parts[i]] = 0
            alike = may[100 * shared >= percent * (size[may] + size[i] - shared)]
            if len(alike):
                edges += [(int(node[i]), int(node[j])) for j in alike]
                reached = np.isin(root[waiting], root[alike])
                front += waiting[reached].tolist()
                waiting = waiting[~reached]
    return edges


def _joining(percent: int):
    """The edges of each group of neighbouring rows (bucket, low, high, node, root, side, shingles)."""
    def run(batches):
        for _, rows in groupby(in_slices(batches), lambda r: r[:3]):
            node, root, side, packed = zip(*[r[3:] for r in rows], strict=True)
            node, root, side = (np.array(c, np.int64) for c in (node, root, side))
            edges = np.array(joining(node, root, side, [np.frombuffer(x, "<u8") for x in packed], percent), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])

    return run


def _likely(percent: int):
    """Pairs whose sketches do not rule a high similarity out."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = (part.column(c).to_pylist() for c in ("x", "y", "n_a", "n_b"))
                keep = [may_be_alike(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), n, m, percent)
                        for x, y, n, m in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _alike(percent: int):
    """Pairs whose similarity, by their whole sets, is high enough."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, keep = batch.slice(at, 256), []
                for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True):
                    both = np.sort(np.concatenate([np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")]))
                    shared = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * shared >= percent * (len(both) - shared))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _beside(pairs: DataFrame, rows: DataFrame, value: str, *more: str) -> DataFrame:
    """Pairs with what ``rows`` (one per node) hold of either."""
    sides = [rows.select(F.col("node").alias(side), F.col(value).alias(name), *[F.col(c).alias(f"n_{side}") for c in more])
             for side, name in (("a", "x"), ("b", "y"))]
    return pairs.join(sides[0], "a").join(sides[1], "b")


class _Texts:
    """Texts (key, text_hash, text) and the sets made of them (one row per node)."""

    def __init__(self, texts: DataFrame, percent: int, width: int, seed: int):
        self.texts, self.percent, self.width, self.seed = texts, percent, width, seed
        self.rows = saved(mapped(texts, _sketches(width, seed), "key long, text_hash long, node long, size long, sketch binary, print long"), "sketches")
        place = F.struct(F.col("key").isNull().alias("last"), "key", "text_hash")
        self.sets = saved(self.rows.groupBy("node").agg(F.min(place).alias("first"), F.first("size").alias("size"),
                                                        F.first("sketch").alias("sketch"), F.first("print").alias("print")), "sets")

    def close(self, radius: int) -> DataFrame:
        """Pairs of sets whose fingerprints are equal or linked: each set with the first of its fingerprint, and the first ones of
        fingerprints that differ in at most ``radius`` bits, as far as they are needed to connect these."""
        heads = saved(self.sets.groupBy("print").agg(F.min("node").alias("head")), "heads")
        same = self.sets.select("node", "print").join(heads, "print").where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b"))
        a, b = (heads.select(F.col("print").alias(f"print_{c}"), F.col("head").alias(f"head_{c}")) for c in "ab")
        met = simhash.links(heads.select("print"), radius).distinct().join(a, F.col("a") == a["print_a"]).join(b, F.col("b") == b["print_b"])
        pairs = saved(same.unionByName(met.select(F.least("head_a", "head_b").alias("a"), F.greatest("head_a", "head_b").alias("b"))), "close")
        discard(heads)
        return pairs

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sketches do not rule a high similarity out."""
        near = _beside(pairs.distinct(), self.sets, "sketch", "size").select("a", "b", "x", "y", "n_a", "n_b")
        return mapped(near, _likely(self.percent), "a long, b long")

    def alike(self, likely: DataFrame) -> DataFrame:
        """The distinct pairs whose whole sets are alike."""
        likely = saved(likely.distinct(), "likely")
        packed = self.packed(likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))))
        alike = saved(mapped(_beside(likely, packed, "shingles").select("a", "b", "x", "y"), _alike(self.percent), "a long, b long"), "alike")
        discard(likely, packed)
        return alike

    def packed(self, asked: DataFrame) -> DataFrame:
        """``node, shingles`` of the sets whose nodes are asked for, made from the texts again."""
        named = saved(self.sets.join(asked.distinct(), "node", "left_semi").select("node", F.col("first.key").alias("_key"),
                                                                                   F.col("first.text_hash").alias("_hash")), "asked")
        found = self.texts.join(named, self.texts["key"].eqNullSafe(named["_key"]) & (self.texts["text_hash"] == named["_hash"]))
        packed = mapped(found.select("node", "text"), _packed(self.width, self.seed), "node long, shingles binary").dropDuplicates(["node"])
        packed = saved(packed, "packed")
        discard(named)
        return packed

    def joined(self, near: DataFrame) -> DataFrame:
        """Edges that connect what links between the members of a bucket (bucket, node, size, root) connect, of all buckets.

        Of buckets with the same members one is enough. Larger ones are cut into blocks.
        """
        told = near.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight"), F.min("node").alias("low"), F.max("node").alias("high"),
                                          F.sum(_mixed("node")).alias("total"), F.bit_xor(F.xxhash64("node")).alias("mix"))
        once = told.groupBy("n", "weight", "low", "high", "total", "mix").agg(F.min("bucket").alias("bucket")).select(
            "bucket", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("weight") / HELD)).cast("int").alias("blocks"))
        dealt = _cut(near.join(once, "bucket")).select("bucket", "low", "high", "node", "root", "side")
        packed = self.packed(near.select("node"))
        groups = dealt.join(packed, "node").select("bucket", "low", "high", "node", "root", "side", "shingles")
        groups = groups.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
        edges = saved(mapped(groups, _joining(self.percent), "a long, b long"), "joining")
        discard(packed)
        return edges

    def members(self) -> DataFrame:
        """``bucket, node, size`` and the bucket's two hubs (structs of node and size), of all buckets of several sets.

        Sets that share many shingles meet in many buckets with the same members; one of these is enough.
        """
        spark, kind = self.texts.sparkSession, "shingle long, node long, size long, hot boolean"
        sampled = mapped(self.texts.where(F.pmod("text_hash", F.lit(8)) == 0), _flat(self.width, self.seed), "shingle long")
        often = sampled.groupBy("shingle").count().where(F.col("count") >= OFTEN)
        top = sorted((r["shingle"] % (1 << 64), r["count"]) for r in often.orderBy(F.desc("count"), "shingle").limit(COMMON).collect())
        least = max(8, self.sets.count() / HOT)
        hot = np.array([s for s, n in top if 8 * n >= least], np.uint64)
        shared = spark.sparkContext.broadcast((np.array([s for s, _ in top], np.uint64), np.array([n for _, n in top], np.int64), hot))
        dealt = saved(mapped(self.texts.select("text"), _deal(shared, self.width, self.seed, self.percent), kind), "dealt")
        turned = F.struct(F.col("node").bitwiseXOR(F.lit(_TURN)).alias("turned"), "node", "size")
        sums = {"low": F.min(F.struct("node", "size")), "high": F.min(turned), "last": F.max("node"),
                "n": F.count(F.lit(1)), "total": F.sum(_mixed("node")), "mix": F.bit_xor(F.xxhash64("node"))}
        own = Window.partitionBy("shingle")
        cold = dealt.where("NOT hot").repartition("shingle").select("node", "size", *[c.over(own).alias(n) for n, c in sums.items()])
        common = dealt.where("hot").groupBy("shingle").agg(*[c.alias(n) for n, c in sums.items()])  # at most COMMON rows
        warm = dealt.where("hot").join(F.broadcast(common), "shingle").select("node", "size", *sums)
        bucket = F.xxhash64("low.node", "last", "n", "total", "mix").alias("bucket")
        met = cold.unionByName(warm).where("low.node != last").select(
            bucket, "node", "size", F.col("low").alias("one"), F.struct("high.node", "high.size").alias("other"))
        found = saved(met.dropDuplicates(["bucket", "node"]), "members")
        discard(dealt)
        return found


def _mixed(node: str) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(1 << 31))


def _cut(rows: DataFrame) -> DataFrame:
    """The rows of a bucket, dealt to ``blocks`` sides, once for every side that theirs meets: ``low`` and ``high``."""
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    turned = rows.withColumn("side", side).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return turned.withColumn("low", F.least("side", "turn")).withColumn("high", F.greatest("side", "turn"))


def _fits(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def links(sets: _Texts, radius: int = 4) -> DataFrame:
    """Edges (a, b) between sets whose components are those of all pairs of that similarity."""
    percent, close, members = sets.percent, sets.close(radius), sets.members()
    hubs = members.select("node", "size", F.explode(F.array("one", "other")).alias("hub")).where(
        (F.col("node") != F.col("hub.node")) & _fits(F.col("size"), F.col("hub.size"), percent))
    met = hubs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
    some = sets.alike(sets.likely(close.unionByName(met)))
    rooted = saved(components(some), "rooted")
    placed = members.select("bucket", "node", "size").join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = saved(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
                  .where("low != high").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "mixed")
    sketched = placed.join(mixed, "bucket").join(sets.sets.select("node", "sketch"), "node")
    groups = _cut(sketched).groupBy("bucket", "low", "high").agg(
        F.collect_list(F.struct("node", "size", "root", "side", "sketch")).alias("members"))
    found = saved(mapped(groups.select("bucket", "members"), _others(percent), "a long, b long, bucket long, size long, root long"), "others")
    others = sets.alike(found.where("b IS NOT NULL").select("a", "b"))
    near = saved(found.where("b IS NULL").select("bucket", F.col("a").alias("node"), "size", "root").distinct(), "near")
    joined = sets.joined(near)
    discard(close, members, rooted, mixed, found, near)
    return some.unionByName(others).unionByName(joined)


def keep_one(docs: DataFrame, percent: int = 80, width: int = 5, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row, with all its columns, of the rows that links connect: the one with the smallest key and then text hash.

    Two rows are linked when their sets of ``width``-word shingles have a similarity of at least ``percent`` %. Texts of fewer
    words are linked when their words are equal, null and wordless texts with each other. Whole texts of any length are
    compared. Rows with a null key come after others; of repeated rows one stays; an empty table gives none.
    """
    sets = _Texts(docs.select(F.col(key).cast("long").alias("key"), text_hash(text), F.col(text).cast("binary").alias("text")),
                  percent, width, seed)
    found = links(sets)
    rooted = components(found).withColumnRenamed("node", "_node")
    first = F.col("first")
    firsts = sets.sets.select("node", "first").join(rooted, F.col("node") == rooted["_node"], "left").groupBy(
        F.coalesce("root", "node").alias("root")).agg(F.min(first).alias("first"))
    chosen = saved(firsts.select(F.col("first.key").alias(key), F.col("first.text_hash").alias("text_hash")), "first")
    discard(sets.rows, sets.sets, found)
    return rows_of(docs, chosen, key, text).dropDuplicates([key, text])
