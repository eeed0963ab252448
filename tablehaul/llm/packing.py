"""Packing by cutting stock: column generation over the histogram of piece lengths.

A document's ids are cut into full sequences and one rest. The rests' histogram (at most ``context / unit`` lengths) is
all that reaches the driver. There a linear program picks patterns (how many rests of each length share a sequence): its
dual prices go into a knapsack by dynamic programming, which returns the best new pattern, until none improves it.
Rounded-down patterns and a best-fit pass over what is left are then dealt to the documents by their rank within
their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.common import in_slices, mapped, numbered, saved, told_apart
from tablehaul.llm.tokens import tokenizer_path, word_ids

_PIECE = "key long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of lengths 1..len(values) whose sum is at most ``capacity`` (unbounded knapsack)."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    useful = np.flatnonzero(values > 0) + 1
    for room in range(1, capacity + 1):
        fits = useful[useful <= room]
        best[room] = best[room - 1]
        if len(fits):
            gain = best[room - fits] + values[fits - 1]
            at = int(np.argmax(gain))
            if gain[at] > best[room] + 1e-12:
                best[room], took[room] = gain[at], fits[at]
    pattern, room = np.zeros(len(values), int), capacity
    while room > 0:
        if took[room]:
            pattern[took[room] - 1] += 1
            room -= took[room]
        else:
            room -= 1
    return best[capacity], pattern


def generate_columns(demand: np.ndarray, capacity: int, gap: float = 1e-3, rounds: int = 4000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used in the linear program's solution, to within ``gap`` of its optimum.

    ``demand[i]`` is the number of pieces of length i + 1. Revised simplex on the cover constraints; the basis starts with
    one pattern per length. Should ``rounds`` run out, the solution is still feasible, only less tight.
    """
    rows = np.flatnonzero(demand)
    if not len(rows):
        return []
    fit = capacity // (rows + 1)
    patterns = [np.where(np.arange(len(demand)) == r, n, 0) for r, n in zip(rows, fit, strict=True)]
    inverse, used = np.diag(1.0 / fit), demand[rows] / fit
    for _ in range(rounds):
        prices = np.zeros(len(demand))
        prices[rows] = inverse.sum(axis=0)
        value, pattern = best_pattern(prices, capacity)
        if value <= 1 + gap:
            break
        step = inverse @ pattern[rows]
        ratio = np.where(step > 1e-11, used / np.where(step > 1e-11, step, 1), np.inf)
        out = int(np.argmin(ratio))
        used = used - ratio[out] * step
        used[out] = ratio[out]
        inverse[out] /= step[out]
        others = np.arange(len(rows)) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        patterns[out] = pattern
    return list(zip(patterns, np.maximum(used, 0), strict=True))


def best_fit(demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """One pattern per sequence for few pieces: the largest piece opens it, then the largest that still fits."""
    left, out = demand.copy(), []
    while left.any():
        pattern, room = np.zeros(len(left), int), capacity
        while room and (fits := np.flatnonzero(left[:room])).size:
            pattern[fits[-1]] += 1
            left[fits[-1]] -= 1
            room -= int(fits[-1]) + 1
        out.append(pattern)
    return out


def plan(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole-number uses of patterns that hold every piece exactly once."""
    chosen = [(p, int(np.floor(x + 1e-9))) for p, x in generate_columns(demand, capacity)]
    left, out = demand.astype(np.int64).copy(), []
    for pattern, times in sorted(chosen, key=lambda c: (-c[1], c[0].tolist())):
        held = pattern > 0
        times = min([times, *(left[held] // pattern[held])])  # a cover may hold more than there is
        if times:
            out.append((pattern, int(times)))
            left -= times * pattern
    merged: dict[tuple, int] = {}
    for pattern in best_fit(left, capacity):
        merged[tuple(pattern)] = merged.get(tuple(pattern), 0) + 1
    return out + [(np.array(p), n) for p, n in merged.items()]


def _cut(path: str, end_id: int, context: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        ids_of, names = word_ids(path), [f.split()[0] for f in _PIECE.split(", ")]
        rows, held = [], 0
        for key, text in in_slices(batches):
            ids = ids_of.text(text or b"") + end
            for at in range(0, len(ids), 4 * context):
                piece = ids[at:at + 4 * context]
                rows.append((key, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece))
            held += len(ids)
            if held > 1 << 22:
                yield _batch(rows, names)
                rows, held = [], 0
        if rows:
            yield _batch(rows, names)

    return run


def _batch(rows, names):
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64())
                                       for c, n in zip(columns, names, strict=True)], names)


def pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, context: int = 2048, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Whole texts encoded, ended by ``end_id`` and cut into pieces of ``context`` ids and a rest; ids as raw bytes.

    A null text counts as empty: one piece that holds the end id.
    """
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    return mapped(texts, _cut(tokenizer or tokenizer_path(), end_id, context), _PIECE)


def assign(cut: DataFrame, context: int = 2048, unit: int = 8, rows_per_block: int = 50_000) -> DataFrame:
    """Add sequence_id and offset to pieces (key, start, length and more; written beforehand, as they are read twice).

    Lengths are rounded up to ``unit`` ids in the plan only, which costs half a unit of padding a piece. Sequence ids are
    0 and up; within a sequence the pieces lie by falling length without gaps. Repeated rows are pieces of their own.
    """
    spark, capacity = cut.sparkSession, context // unit
    graded = cut.withColumn("grade", F.when(F.col("length") == context, 0).otherwise(
        F.ceil(F.col("length") / unit)).cast("int"))
    counts = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}  # at most capacity + 1 rows
    demand = np.array([counts.get(n, 0) for n in range(1, capacity + 1)], np.int64)
    slots, first, taken = [], 0, np.zeros(capacity, np.int64)
    for pattern, times in plan(demand, capacity):
        for i in np.flatnonzero(pattern):
            here = int(pattern[i]) * times
            slots.append((int(i) + 1, int(taken[i]), int(taken[i]) + here, int(pattern[i]), first))
            taken[i] += here
        first += times
    slots.append((0, 0, counts.get(0, 0), 1, first))
    table = spark.createDataFrame(slots, "grade int, rank_from long, rank_to long, together long, first_sequence long")
    order = ["key", "start", "ids_crc32", "doc_tokens", "_repeat"]
    ranked = numbered(told_apart(graded, "_repeat"), ["grade"], order, sum(counts.values()), "rank", rows_per_block)
    placed = ranked.join(table, (ranked["grade"] == table["grade"]) & (ranked["rank"] >= table["rank_from"])
                         & (ranked["rank"] < table["rank_to"])).withColumn(
        "sequence_id", F.col("first_sequence") + F.floor((F.col("rank") - F.col("rank_from")) / F.col("together")))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc(ranked["grade"]), "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).select(
        *cut.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, context: int = 2048, unit: int = 8,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, its end id included, lies in exactly one piece; texts of any length are encoded whole. Null texts
    count as empty, null keys and repeated rows are documents like others, pieces of equal length go in the order of their
    keys' hashes, an empty table gives no rows, and other columns are not read. The pieces with their ids stay in the
    shared folder; ``sequences`` puts such pieces together.
    """
    cut = saved(pieces(docs, tokenizer, end_id, context, key, text), "pieces")
    return assign(cut.drop("ids"), context, unit).withColumnRenamed("key", key)


def sequences(placed: DataFrame) -> DataFrame:
    """The ids (array<long>) of each sequence from placed pieces that carry ``ids``; at most one context each."""
    def join(batches):
        for batch in batches:
            rows = batch.to_pylist()
            ids = [np.concatenate([np.frombuffer(p["ids"], "<u4") for p in sorted(r["parts"], key=lambda p: p["offset"])])
                   .astype(np.int64) for r in rows]
            yield pa.RecordBatch.from_pydict({"sequence_id": pa.array([r["sequence_id"] for r in rows], pa.int64()),
                                              "ids": pa.array(ids, pa.list_(pa.int64()))})

    gathered = placed.groupBy("sequence_id").agg(F.collect_list(F.struct("offset", "ids")).alias("parts"))
    return mapped(gathered, join, "sequence_id long, ids array<long>")
