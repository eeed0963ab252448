"""Nearest neighbours by a robust-pruned directed graph per shard.

Equal vectors become one node. Nodes are dealt by hash into shards of bounded size; in each a graph is built in numpy:
a greedy search from the entry point proposes neighbours for every node, relaxed distance pruning keeps a diverse few of
them, edges run both ways, and nodes with too many are pruned again (Subramanya et al., "DiskANN", 2019). A query goes
through every shard with a beam search, in blocks of queries that step together, and the best of all shards are kept.

Inner products are turned into distances by one more coordinate that lifts all nodes of a shard to the same length. Shards
hold vectors of like length and work in double precision, so a long vector does not drown the differences of short ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.common import blocks_for, mapped, saved, ship

_INDEX = "shard int, dim int, n long, vectors binary, owners binary, owner_ends binary, edges binary, entry int"


def _distances(base: np.ndarray, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``base`` to the points that its row of ``ids`` names."""
    there = points[ids]
    cross = np.matmul(there, base[:, :, None])[:, :, 0]
    return (base * base).sum(1)[:, None] - 2 * cross + (there * there).sum(2)


def beam(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every query the ``width`` nearest nodes that a best-first walk over the graph meets, nearest first: ids and
    squared distances (-1 and infinity where there are fewer). Queries walk together, one expanded node each per step."""
    n, m = len(points), len(queries)
    ids = np.full((m, width), -1, np.int64)
    far = np.full((m, width), np.inf)
    done = np.ones((m, width), bool)
    seen = np.zeros((m, n), bool)
    ids[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    far[:, 0] = _distances(queries, points, ids[:, :1])[:, 0]
    live = np.arange(m)
    while len(live):
        first = np.argmin(done[live], axis=1)  # beams are sorted: the first open node is the nearest
        open_ = ~done[live, first]
        live, first = live[open_], first[open_]
        if not len(live):
            break
        done[live, first] = True
        near = edges[ids[live, first]]
        fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        row, column = np.nonzero(fresh)
        seen[live[row], near[row, column]] = True
        spread = np.where(fresh, _distances(queries[live], points, np.maximum(near, 0)), np.inf)
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_far = np.concatenate([far[live], spread], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :width]
        far[live] = np.take_along_axis(all_far, order, 1)
        ids[live] = np.where(np.isinf(far[live]), -1, np.take_along_axis(all_ids, order, 1))
        done[live] = np.take_along_axis(all_done, order, 1) | np.isinf(far[live])
    return ids, far


def prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """For each node up to ``degree`` of its candidates (-1: none): the nearest is kept, and every candidate that is nearer
    to it, by the factor ``slack``, than to the node goes; and so on."""
    ordered = np.sort(candidates, axis=1)
    repeats = np.concatenate([np.zeros((len(nodes), 1), bool), ordered[:, 1:] == ordered[:, :-1]], axis=1)
    open_ = (ordered >= 0) & ~repeats & (ordered != nodes[:, None])
    there = points[np.maximum(ordered, 0)]
    length = (there * there).sum(2)
    mine = points[nodes]
    own = (mine * mine).sum(1)[:, None] - 2 * np.matmul(there, mine[:, :, None])[:, :, 0] + length
    out, rows = np.full((len(nodes), degree), -1, np.int64), np.arange(len(nodes))
    for place in range(degree):
        score = np.where(open_, own, np.inf)
        best = np.argmin(score, axis=1)
        has = np.isfinite(score[rows, best])
        if not has.any():
            break
        out[has, place] = ordered[rows, best][has]
        chosen = there[rows, best]
        between = (length[rows, best][:, None] - 2 * np.matmul(there, chosen[:, :, None])[:, :, 0] + length)
        open_ &= ~((slack * slack * between <= own) | (np.arange(ordered.shape[1]) == best[:, None]))
    return out


def build(points: np.ndarray, degree: int, width: int, slack: float, seed: int, step: int = 256) -> tuple[np.ndarray, int]:
    """Edges (rows of node ids, -1 where there are fewer) and the entry point, the node nearest the middle."""
    n, rng = len(points), np.random.default_rng(seed)
    entry = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    edges = np.full((n, degree), -1, np.int64)
    if n > 1:
        start = min(n - 1, degree // 2)  # a random graph to begin with
        edges[:, :start] = (np.arange(n)[:, None] + rng.integers(1, n, (n, start))) % n
    order = rng.permutation(n)
    for at in range(0, n, step):
        nodes = order[at:at + step]
        met, _ = beam(points, edges, entry, points[nodes], width)
        edges[nodes] = prune(points, nodes, np.concatenate([met, edges[nodes]], axis=1), degree, slack)
        # Edges back: gathered by their end, then all nodes that are hit are pruned together.
        ends, begins = edges[nodes].ravel(), np.repeat(nodes, degree)
        ends, begins = ends[ends >= 0], begins[ends >= 0]
        by = np.argsort(ends, kind="stable")
        ends, begins = ends[by], begins[by]
        hit, first, count = np.unique(ends, return_index=True, return_counts=True)
        back = np.full((len(hit), min(int(count.max(initial=0)), 2 * degree)), -1, np.int64)
        rank = np.arange(len(ends)) - np.repeat(first, count)
        fits = rank < back.shape[1]
        back[np.repeat(np.arange(len(hit)), count)[fits], rank[fits]] = begins[fits]
        edges[hit] = prune(points, hit, np.concatenate([edges[hit], back], axis=1), degree, slack)
    return edges, entry


def lifted(vectors: np.ndarray) -> np.ndarray:
    """The vectors scaled to at most 1 and one more coordinate, so that all have the longest one's length and nearest means
    largest inner product."""
    scaled = vectors.astype(np.float64) / np.abs(vectors).max()
    square = (scaled ** 2).sum(1)
    return np.concatenate([scaled, np.sqrt(np.maximum(square.max() - square, 0))[:, None]], axis=1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vector (array<double>) of the rows that take part."""
    numbers = F.col(vector).cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(key).cast("long").alias("key"), numbers.alias("vector")).filter(
        F.col("key").isNotNull() & finite & F.exists(numbers, lambda x: x != 0))


def build_index(vectors: DataFrame, k: int = 20, shard_size: int = 4096, degree: int = 32, width: int = 64,
                slack: float = 1.2, seed: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per shard: its distinct vectors, the ``k`` + 1 smallest keys of each, and its graph.

    No more keys are needed of a vector: rows that share one are equally near everything. Shards hold vectors of one
    dimension only, whose largest numbers are within a factor of 2**16 of each other.
    """
    rows = usable(vectors, key, vector).dropDuplicates(["key", "vector"])
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("vector").orderBy("key"))).filter(
        F.col("_rank") <= k + 1)
    nodes = saved(ranked.groupBy("vector").agg(F.sort_array(F.collect_list("key")).alias("owners")), "nodes")
    dims, band = F.size("vector"), F.floor((F.log2(F.array_max(F.transform("vector", F.abs))) + 8) / 16)
    lengths = {(r["dim"], r["band"]): blocks_for(r["count"], shard_size) for r in
               nodes.groupBy(dims.alias("dim"), band.alias("band")).count().collect()}
    shard, base = F.lit(0), 0
    for (dim, level), shards in sorted(lengths.items()):
        shard = F.when((dims == dim) & (band == level), F.pmod(F.xxhash64("vector"), F.lit(shards)) + base).otherwise(shard)
        base += shards

    def graph(key: tuple, table: pa.Table) -> pa.Table:
        column, owners = table.column("vector").combine_chunks(), table.column("owners").combine_chunks()
        dim = len(column[0])
        exact = column.flatten().to_numpy().reshape(-1, dim)
        order = np.lexsort(exact.T[::-1])  # the same graph whatever order the rows arrive in
        owners = owners.take(pa.array(order))
        edges, entry = build(lifted(exact[order]), degree, width, slack, seed)
        ends = np.cumsum([len(o) for o in owners])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([dim], pa.int32()),
                         "n": pa.array([len(order)], pa.int64()),
                         "vectors": pa.array([exact[order].astype("<f8").tobytes()], pa.binary()),
                         "owners": pa.array([owners.flatten().to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "owner_ends": pa.array([ends.astype("<i8").tobytes()], pa.binary()),
                         "edges": pa.array([edges.astype("<i4").tobytes()], pa.binary()),
                         "entry": pa.array([entry], pa.int32())})

    ship(vectors.sparkSession)
    return saved(nodes.withColumn("shard", shard.cast("int")).groupBy("shard").applyInArrow(graph, _INDEX), "graph")


def _search(k: int, width: int, block: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                dim, n = row["dim"], row["n"]
                exact = np.frombuffer(row["vectors"], "<f8").reshape(n, dim)
                owners, ends = np.frombuffer(row["owners"], "<i8"), np.frombuffer(row["owner_ends"], "<i8")
                edges = np.frombuffer(row["edges"], "<i4").astype(np.int64).reshape(n, -1)
                points = lifted(exact)
                keys, all_queries = np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["queries"], "<f8").reshape(-1, dim)
                for at in range(0, len(keys), block):
                    queries = all_queries[at:at + block]
                    ids, _ = beam(points, edges, row["entry"], np.concatenate(
                        [queries / np.abs(queries).max(1, keepdims=True), np.zeros((len(queries), 1))], axis=1), width)
                    score = np.einsum("qd,qwd->qw", queries, exact[np.maximum(ids, 0)])
                    who, place = np.nonzero(ids >= 0)
                    first = np.where(ids[who, place] > 0, ends[ids[who, place] - 1], 0)
                    count = ends[ids[who, place]] - first
                    owner = owners[np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
                    asked, scores = np.repeat(keys[at:at + block][who], count), np.repeat(score[who, place], count)
                    other = asked != owner
                    asked, owner, scores = asked[other], owner[other], scores[other]
                    by = np.lexsort((owner, -scores, asked))
                    asked, owner, scores = asked[by], owner[by], scores[by]
                    _, begin, length = np.unique(asked, return_index=True, return_counts=True)
                    best = np.arange(len(asked)) - np.repeat(begin, length) < k
                    yield pa.RecordBatch.from_arrays([pa.array(asked[best]), pa.array(owner[best]), pa.array(scores[best])],
                                                     ["query_id", "vec_id", "score"])

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 20, width: int = 96, block: int = 256, pack: int = 2048,
           key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score (inner product in double precision on the original vectors) of the ``k``
    nearest that the beams of all shards find, ties to the smaller id; a query never finds its own id.

    Queries are packed into blocks of about ``pack`` and each block visits every shard of vectors of its length.
    """
    asked = saved(usable(queries, key, vector).withColumn("dim", F.size("vector")).distinct(), "queries")
    packs = blocks_for(asked.count(), pack)

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        column = table.column("vector").combine_chunks()
        return pa.table({"dim": pa.array([len(column[0])], pa.int32()),
                         "keys": pa.array([table.column("key").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "queries": pa.array([column.flatten().to_numpy().astype("<f8").tobytes()], pa.binary())})

    ship(queries.sparkSession)
    blocks = asked.withColumn("pack", F.pmod(F.xxhash64("key"), F.lit(packs))).groupBy("dim", "pack").applyInArrow(
        gather, "dim int, keys binary, queries binary")
    # Shards and blocks of one length meet once each: the join is on the shard, which every block is sent to.
    places = F.broadcast(index.groupBy("dim").agg(F.collect_list("shard").alias("shards")))
    sent = blocks.join(places, "dim").select(F.explode("shards").alias("shard"), "keys", "queries")
    met = index.join(sent, "shard").repartition(F.col("shard"), F.xxhash64("keys"))
    found = mapped(met, _search(k, width, block), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding",
            **options) -> DataFrame:
    """The ``k`` nearest rows of each row whose key is divisible by ``every``, among all other rows.

    Vectors that are null, empty, all zero or hold null or non-finite numbers, and rows without a key, take no part. Vectors
    of different lengths never meet. Rows that repeat a key and vector count once; a key with two vectors is two
    candidates under one id. Fewer candidates than ``k`` are all returned; an empty table gives no rows; other columns
    are not read.
    """
    index = build_index(vectors, k, key=key, vector=vector, **options)
    return search(index, vectors.filter(F.col(key) % every == 0), k, key=key, vector=vector)
