"""Stored rows of a block beside the queries that go to it, in tasks that hold one block's stored rows at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablehaul.llm.common import mapped

Batches = Iterator[pa.RecordBatch]


def pieces(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Neighbouring rows of one block and kind, few at a time; ``block`` and ``kind`` are the first two columns."""
    for batch in batches:
        block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            for at in range(a, b, rows):
                yield int(block[at]), int(kind[at]), batch.slice(at, min(rows, b - at))


def beside(dealt: DataFrame, build: Callable[[list[pa.RecordBatch]], object],
           answer: Callable[[object, int, pa.RecordBatch], Batches], schema: str, rows: int = 4096) -> DataFrame:
    """What ``answer`` gives for the queries of each block.

    ``dealt`` has block (long), kind (int, 0 for stored rows, more for queries) and further columns, all rows of a block in one
    partition. They are sorted there, so that a task first reads a block's stored rows, of which there have to be few enough
    for its memory, and then its queries, of which there may be any number, ``rows`` at a time.
    """
    def run(batches: Batches) -> Batches:
        now, held, state = None, [], None
        for block, kind, piece in pieces(batches, rows):
            if block != now:
                now, held, state = block, [], None
            if kind == 0:
                held.append(piece)
            elif held or state is not None:
                if state is None:
                    state, held = build(held), []
                yield from answer(state, kind, piece)

    return mapped(dealt.sortWithinPartitions("block", "kind"), run, schema)
