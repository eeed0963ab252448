"""Hard negatives, scored by Kronecker-packed products of whole numbers.

A block's vectors are packed component by component: the d-th components of many candidates, raised by a bias so that none is
negative, lie side by side in fields of one wide integer. Multiplying that integer by the anchor's d-th component multiplies all fields at once;
the sum over the components holds every candidate's product in a field of its own. Fields are as wide as the largest sum possible, so
nothing runs over, and taking the biases out again gives the exact scores, whatever the size of the numbers.

Anchors go to every block of candidates, a block at a time, once for their positives and once for the negatives in each
positive's window. Each block answers with its best few, which are ranked once more per anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.blocks import beside
from tablehaul.llm.common import blocks_for, saved

#: Candidates in one wide integer.
PACKED = 2048
_LONG = np.iinfo(np.int64)


def scaled(rows: np.ndarray, scale: int = 256) -> np.ndarray:
    """floor(scale * x) of every component: int64 where that is exact, else Python's integers."""
    whole = np.floor(scale * rows)
    if not whole.size or np.abs(whole).max() < 2.0 ** 53:
        return whole.astype(np.int64)
    return np.array([[int(v) for v in row] for row in whole], object).reshape(whole.shape)


def _bytes(values: np.ndarray, width: int) -> bytes:
    """Whole numbers that are not negative as fields of ``width`` bytes."""
    if values.dtype == object or width > 8:
        return b"".join(int(v).to_bytes(width, "little") for v in values)
    return np.ascontiguousarray(values.astype("<u8")[:, None].view(np.uint8)[:, :width]).tobytes()


def _fields(total: int, n: int, width: int) -> np.ndarray:
    """The numbers in the fields of a wide integer."""
    raw = total.to_bytes(n * width, "little")
    if width <= 7:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8).reshape(n, width)
        return wide.view("<i8")[:, 0]
    return np.array([int.from_bytes(raw[at:at + width], "little") for at in range(0, n * width, width)], object)


class Packed:
    """Up to ``PACKED`` candidates with whole components, all of one number of components."""

    def __init__(self, rows: np.ndarray):
        self.n, self.dims = rows.shape
        self.rows = rows
        self.low = int(rows.min()) if rows.size else 0
        self.top = [int(c) - self.low for c in rows.max(0)]
        sums = [sum(row) for row in rows.tolist()]
        self.most = max(map(abs, sums), default=0)
        self.sums = np.array(sums, np.int64 if self.most < 1 << 62 else object)
        self.made: dict[int, list[int]] = {}

    def _columns(self, width: int) -> list[int]:
        if width not in self.made:
            self.made[width] = [int.from_bytes(_bytes(self.rows[:, d] - self.low, width), "little") for d in range(self.dims)]
        return self.made[width]

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product of every candidate with the anchor, exact, as longs."""
        least = min(anchor, default=0)
        raised = [a - least for a in anchor]
        largest = max(sum(a * t for a, t in zip(raised, self.top, strict=True)), *self.top)
        width = max(4, -(-(largest.bit_length() + 1) // 8))
        total = 0
        for a, column in zip(raised, self._columns(width), strict=True):
            if a:
                total += a * column
        fields = _fields(total, self.n, width)
        # (a - least)(x - low) = a x - low a - least x + least low, summed up.
        taken, constant = self.sums, self.low * sum(anchor) - least * self.low * self.dims
        if largest + abs(constant) + abs(least) * self.most >= 1 << 62:
            exact = fields.astype(object) + constant + least * taken.astype(object)
            return np.array([min(max(int(v), int(_LONG.min)), int(_LONG.max)) for v in exact], np.int64)
        return fields.astype(np.int64) + constant + least * taken


def _vectors(batches: list[pa.RecordBatch]) -> np.ndarray:
    """The vectors of record batches, all of one length, in double precision."""
    parts = [b.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64) for b in batches]
    n = sum(b.num_rows for b in batches)
    return np.concatenate(parts).reshape(n, -1)


class _Candidates:
    """A block's candidates in the order of their ids, so that the first of equal scores has the smallest id."""

    def __init__(self, held: list[pa.RecordBatch]):
        ids = np.concatenate([b.column("id").to_numpy() for b in held])
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], np.concatenate([b.column("label").to_numpy() for b in held])[order]
        whole = scaled(_vectors(held)[order])
        self.packed = [Packed(whole[at:at + PACKED]) for at in range(0, len(whole), PACKED)]

    def scores(self, anchor: list[int]) -> np.ndarray:
        return np.concatenate([p.scores(anchor) for p in self.packed])


def _best(scores: np.ndarray, chosen: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` highest of the chosen places, highest first, the first of equals first."""
    mine = scores[chosen]
    if len(mine) > most:
        chosen = chosen[mine >= np.partition(mine, len(mine) - most)[len(mine) - most]]
        mine = scores[chosen]
    return chosen[np.argsort(-mine.astype(np.float64) if mine.size and mine.min() == _LONG.min else -mine, kind="stable")[:most]]


def _positives(most: int):
    def answer(block: _Candidates, kind: int, piece: pa.RecordBatch):
        whole, out = scaled(_vectors([piece])), []
        for i, (anchor, own, label) in enumerate(zip(*(piece.column(c).to_pylist() for c in ("anchor", "id", "label")), strict=True)):
            scores = block.scores(whole[i].tolist())
            best = _best(scores, np.flatnonzero((block.labels == label) & (block.ids != own)), most)
            out += zip([anchor] * len(best), block.ids[best].tolist(), scores[best].tolist(), strict=True)
        yield from _batch(out, ["anchor", "id", "score"])

    return answer


def _negatives(most: int, low: int, high: int):
    def answer(block: _Candidates, kind: int, piece: pa.RecordBatch):
        whole, out = scaled(_vectors([piece])), []
        columns = (piece.column(c).to_pylist() for c in ("anchor", "id", "label", "positive_scores"))
        for i, (anchor, own, label, positives) in enumerate(zip(*columns, strict=True)):
            scores = block.scores(whole[i].tolist())
            others = np.flatnonzero((block.labels != label) & (block.ids != own))
            mine = scores[others]
            for place, positive in enumerate(positives):
                # The whole numbers s with low * positive <= 100 * s <= high * positive; a score is a long, and so are the ends.
                first, last = max(-(-low * positive // 100), int(_LONG.min)), min(high * positive // 100, int(_LONG.max))
                best = _best(scores, others[(mine >= first) & (mine <= last)], most) if first <= last else []
                out += zip([anchor] * len(best), [place] * len(best), block.ids[best].tolist(), scores[best].tolist(), strict=True)
        yield from _batch(out, ["anchor", "place", "id", "score"])

    return answer


def _batch(rows: list[tuple], names: list[str]):
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*rows, strict=True)], names)


def _finite(vector: Column, scale: int) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))


def _ranked(df: DataFrame, by: list[str], most: int, place: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return df.withColumn(place, F.row_number().over(order)).where(F.col(place) <= most)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   rows_per_block: int = 8192, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every anchor, positive and negative.

    Anchors are the rows whose key ``every`` divides. A score is the inner product of the components floor(256 * x). An
    anchor's positives are the first ``positives`` rows of its label, by score and then the smaller key; the negatives of a
    positive are the first rows of other labels with low * positive_score <= 100 * score <= high * positive_score.

    Rows with a null key, label or vector, with a component that is null or not finite (256 times), or without components have no part.
    Rows that are equal in all three count once; others of one key are rows of their own, which never meet each other. Vectors with
    different numbers of components do not meet. Ties go by key; a score beyond a long's range counts as the nearest long.
    Other columns are not read; an empty table gives no rows. Vectors may be of any length and size.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND size(vector) > 0").where(_finite(F.col("vector"), 256)).distinct()
    stored = saved(rows, "vectors")
    blocks = blocks_for(stored.count(), rows_per_block)
    part = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int")
    inside = (F.size("vector").cast("long") * blocks + F.col("part")).alias("block")
    none = F.lit(None)
    candidates = stored.withColumn("part", part).select(inside, F.lit(0).alias("kind"), "part", "id", "label", "vector",
                                                        none.cast("long").alias("anchor"), none.cast("array<long>").alias("positive_scores"))
    anchors = saved(stored.where(F.col("id") % every == 0).withColumn("anchor", F.monotonically_increasing_id()), "anchors")

    def answered(asked: DataFrame, answer, schema: str) -> DataFrame:
        sent = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
            inside, F.lit(1).alias("kind"), "part", "id", "label", "vector", "anchor", "positive_scores")
        return beside(candidates.unionByName(sent).repartitionById(blocks, "part"), _Candidates, answer, schema)

    first = answered(anchors.withColumn("positive_scores", none.cast("array<long>")), _positives(positives), "anchor long, id long, score long")
    place = (F.col("place") - 1).cast("long").alias("place")
    found = saved(_ranked(first, ["anchor"], positives, "place").select("anchor", place, "id", "score"), "positives")
    scores = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score")))["score"].alias("positive_scores"))
    second = answered(anchors.join(scores, "anchor"), _negatives(negatives, low, high), "anchor long, place long, id long, score long")
    chosen = _ranked(second, ["anchor", "place"], negatives, "rank").select(
        "anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = found.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(
        anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return chosen.join(named, ["anchor", "place"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                                                          "positive_score", "negative_score")


#: The same in SQL for DuckDB, over ``embeddings`` with the labels of op13's contract.
SQL = """
WITH taking AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS alike, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM taking a JOIN taking c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
