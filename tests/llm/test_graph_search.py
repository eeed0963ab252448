import numpy as np
import pytest

from tablehaul.llm.graph_search import beam, build, lifted, nearest, prune


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")


def exact(rows, every, k):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in usable:
        if i % every == 0:
            near = sorted((-float(v @ w), j) for j, w in usable if j != i and len(w) == len(v))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def test_recall_of_the_graph():
    x = np.random.default_rng(0).normal(size=(3000, 24)) * np.random.default_rng(1).uniform(0.5, 2, (3000, 1))
    points = lifted(x)
    edges, entry = build(points, 32, 64, 1.2, 5)
    assert edges.max() < 3000 and not (edges == np.arange(3000)[:, None]).any()
    ids, far = beam(points, edges, entry, np.concatenate([x[:100], np.zeros((100, 1))], 1).astype(np.float32), 96)
    want = np.argsort(-(x[:100] @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(a[:20]) & set(b)) / 20 for a, b in zip(ids, want, strict=True)]) > 0.9
    assert (np.diff(far, axis=1) >= 0).all()


def test_pruning_by_hand():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [-5, 0]], np.float32)
    got = prune(points, np.array([0]), np.array([[4, 2, 1, 3, 1, -1, 0]]), 3, 1.0)
    assert got.tolist() == [[1, 3, 4]]


@pytest.mark.parametrize("shard_size", [4096, 50])
def test_against_brute_force(spark, shard_size):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=8).round(2).tolist()) for i in range(300)]
    same = rng.normal(size=8).round(2).tolist()
    rows += [(1000 + i, same) for i in range(60)] + [(5, None), (10, []), (15, [0.0] * 8), (20, [1.0, None] * 4), (25, [float("nan")] * 8),
                                                      (30, [float("inf")] * 8), (None, same), (2000, [1.0, 2.0]), (2001, [3.0, 1.0])]
    rows = [r for r in rows if r[0] is None or r[0] >= 31 or r[1] is None or len(r[1]) != 8 or not np.isfinite([x or 0 for x in r[1]]).all() or any(r[1])]
    got = {}
    for r in nearest(vectors(spark, rows), 20, 20, shard_size=shard_size).collect():
        got.setdefault(r.query_id, []).append(r)
    want = exact(rows, 20, 20)
    assert set(got) == set(want)
    hits = total = 0
    for q, near in want.items():
        mine = sorted(got[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(near) + 1)) and all(r.vec_id != q for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & {j for j, _ in near})
        total += len(near)
        exactly = dict(near)
        assert all(abs(r.score - exactly[r.vec_id]) < 1e-12 for r in mine if r.vec_id in exactly)
    assert hits >= 0.97 * total


def test_few_and_none(spark):
    assert nearest(vectors(spark, [])).count() == 0 and nearest(vectors(spark, [(20, [1.0, 0.0])])).count() == 0
    got = nearest(vectors(spark, [(20, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [2.0, 5.0]), (20, [1.0, 0.0])])).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 2.0), (2, 2, 2.0)]


def test_repeated_rows_count_once(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), rng.normal(size=6).round(2).tolist()) for i in range(1, 60)]
    rows += [(100 + i, [4.0, 1.0, 1.0, 1.0, 1.0, 1.0]) for i in range(3)]
    want = exact(rows, 20, 20)
    got = {}
    for r in nearest(vectors(spark, rows * 3 + [rows[-3]] * 25), 20, 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert {q: [i for _, i in sorted(found)] for q, found in got.items()} == {q: [i for i, _ in near] for q, near in want.items()}


def test_one_long_vector_hides_no_other(spark):
    rng = np.random.default_rng(9)
    unit = rng.normal(size=(800, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    rows = [(i + 1, v.tolist()) for i, v in enumerate(unit)]
    rows += [(2001, [1e4 * x for x in rows[5][1]]), (2002, [1e20 * x for x in rows[9][1]]), (2003, [200 * x for x in rows[11][1]])]
    want, got = exact(rows, 20, 20), {}
    for r in nearest(vectors(spark, rows), 20, 20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {j for j, _ in near}) for q, near in want.items())
    assert hits >= 0.97 * sum(map(len, want.values()))
