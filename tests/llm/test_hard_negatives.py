import duckdb
import numpy as np

from tablehaul.llm import hard_negatives as module
from tablehaul.llm.hard_negatives import Packed, hard_negatives, scaled
from tablehaul.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<double>, label int"
LEAST, MOST = -2**63, 2**63 - 1


def whole(vector):
    out = []
    for x in vector:
        x = 256 * float(x)
        out.append(int(x) - (x < 0 and x != int(x)))
    return out


def by_hand(rows, every=100):
    taking = {(i, label, tuple(v)) for i, v, label in rows if i is not None and v and label is not None
              and all(x is not None and np.isfinite(256 * float(x)) for x in v)}
    out = []
    for i, label, v in taking:
        if i % every:
            continue
        scored = sorted((-min(max(sum(a * b for a, b in zip(whole(v), whole(w), strict=True)), LEAST), MOST), j, other)
                        for j, other, w in taking if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            some = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(some, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_packed_products():
    rng = np.random.default_rng(2)
    for rows in (rng.integers(-256, 256, (300, 64)), rng.integers(0, 2, (5, 3)), rng.integers(-(1 << 40), 1 << 40, (50, 8)),
                 np.full((4, 3), -7), np.zeros((2, 1), np.int64), rng.integers(-3, 3, (3, 700))):
        packed = Packed(rows)
        for anchor in [rows[0].tolist(), [0] * rows.shape[1], [-5] * rows.shape[1], [1 << 45] * rows.shape[1]]:
            want = [min(max(sum(a * b for a, b in zip(anchor, r, strict=True)), LEAST), MOST) for r in rows.tolist()]
            assert packed.scores(anchor).tolist() == want
    assert scaled(np.array([[0.5, -0.001], [1e300, 0.0]])).tolist() == [[128, -1], [int(256e300), 0]]


def test_against_sql(spark):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        want = duckdb.sql(module.SQL.replace("FROM embeddings", f"FROM '{folder}/embeddings.parquet'")).fetchall()
        assert want and got(QUERIES["op13_hard_negatives"](spark, folder)) == sorted(want)


def test_against_brute_force_over_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(3000):
        v = centres[rng.integers(12)] + rng.normal(size=16) * rng.choice([0.0, 0.3])  # many equal vectors
        rows.append((i * 10, [float(x) for x in v], int(rng.integers(4))))
    monkeypatch.setattr(module, "PACKED", 100)
    df = spark.createDataFrame(rows, KIND)
    want = by_hand(rows)
    assert len(want) > 5000 and got(hard_negatives(df, rows_per_block=250)) == want
    assert got(hard_negatives(df)) == want


def test_a_row_given_5000_times(spark):
    rows = [(100, [0.5, 1.0], 1)] * 5000 + [(101 + i, [0.25 + i / 100, 0.5], i % 3) for i in range(40)]
    assert got(hard_negatives(spark.createDataFrame(rows, KIND), rows_per_block=10)) == by_hand(rows)


def test_odd_rows(spark):
    big, nan, inf = 1e30, float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [2.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.5], 2), (-100, [1.0, 0.5], 2),
            (4, None, 1), (5, [1.0, 1.0], None), (6, [None, 1.0], 2), (7, [nan, 1.0], 2), (8, [inf, 1.0], 2), (None, [1.0, 1.0], 1), (9, [], 2),
            (200, [1.0, 1.0, 1.0], 1), (201, [0.5, 0.5, 0.5], 2), (202, [1.0, 1.0, 1.0], 1), (300, [0.0, 0.0], 2), (301, [-1.0, -2.0], 2),
            (400, [big, 1.0], 1), (401, [big, -big], 1), (402, [big / 2, 1.0], 2), (403, [1e305 * 100, 1.0], 2), (500, [1.0] * 3000, 1), (501, [1.0] * 3000, 1),
            (502, [0.5] * 3000, 3)]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS id", "2 AS part", "3 AS block", "4 AS anchor", "5 AS score", "6 AS vector")
    assert got(hard_negatives(df)) == by_hand(rows)
    assert got(hard_negatives(df, rows_per_block=3)) == by_hand(rows)
    assert hard_negatives(df.limit(0)).count() == 0
