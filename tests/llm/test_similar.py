import numpy as np

import corpus_pipeline
from tablehaul.llm import similar
from tablehaul.llm.similar import keep_one, may_be_alike, prefix, shingles, sketch
from tests.llm.helpers import frame, odd_rows


def sets_of(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 5 else {b" ".join(words)}


def kept_by_hand(rows):
    sets, root = [sets_of(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {min(rows[j][0] for j in range(len(rows)) if top(j) == top(i)) for i in range(len(rows))}


def edited(rng, words, edits):
    words = list(words)
    for at in rng.choice(len(words), edits, replace=False):
        words[at] = f"new{rng.integers(1 << 30)}"
    return words


def test_sets():
    assert len(shingles(b"A b c d e F")) == 2 and len(shingles(b"a b")) == 1 and shingles(b"A  b").tolist() == shingles(b"a b").tolist()
    assert shingles(None).tolist() == shingles(b" ").tolist()
    assert [len(prefix(np.arange(n, dtype=np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), 80)) for n in (1, 4, 5, 10, 15, 16)] == [1, 1, 2, 3, 4, 4]
    last = prefix(np.arange(5, dtype=np.uint64), np.array([0, 1], np.uint64), np.array([9, 5]), 80)
    assert last.tolist() == [2, 3]


def test_against_all_pairs(spark, monkeypatch):
    rng, rows = np.random.default_rng(4), []
    passage = [f"p{i}" for i in range(30)]
    for group in range(40):
        words = [f"g{group}w{rng.integers(1 << 30)}" for _ in range(200)] + (passage if group % 2 else [])
        for copy in range(5):
            rows.append((len(rows), " ".join(edited(rng, words, int(rng.integers(0, 9))))))
    base = [f"hot{i}" for i in range(150)]
    rows += [(1000 + i, " ".join(edited(rng, base, int(rng.integers(0, 6))))) for i in range(60)]
    want = kept_by_hand(rows)
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows])
    for often in (4, 10**9):
        monkeypatch.setattr(similar, "OFTEN", often)
        assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == want


def test_sketches_rule_out_no_similar_pair():
    rng = np.random.default_rng(8)
    ruled_out = 0
    for n in (1, 5, 40, 300, 5000):
        for _ in range(60):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            b = np.unique(np.concatenate([a[rng.random(n) < rng.random() * 0.5 + 0.5], rng.integers(0, 1 << 63, int(rng.integers(0, n))).astype(np.uint64)]))
            a = np.unique(a)
            shared = len(np.intersect1d(a, b))
            alike = 100 * shared >= 80 * (len(a) + len(b) - shared)
            kept = may_be_alike(sketch(a), sketch(b), len(a), len(b), 80)
            assert kept or not alike
            ruled_out += not kept
    assert ruled_out > 150


def test_hot_buckets(spark, monkeypatch):
    """Unlike texts made of few common lines, many near copies, and many exact ones, in one table."""
    rng, lines = np.random.default_rng(9), [[f"line{i}word{j}" for j in range(12)] for i in range(40)]
    rows = [(i, " ".join(w for x in rng.choice(40, 15, replace=False) for w in lines[x])) for i in range(400)]
    base = [f"hot{i}" for i in range(150)]
    rows += [(1000 + i, " ".join(edited(rng, base, int(rng.integers(0, 6))))) for i in range(300)]
    rows += [(2000 + i, "a text that is here " + "very often " * 20) for i in range(300)]
    want = kept_by_hand(rows)
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows])
    for hot, block in ((1000, 1024), (1, 16), (10**6, 64)):
        monkeypatch.setattr(similar, "HOT", hot)
        monkeypatch.setattr(similar, "BLOCK", block)
        assert {r.doc_id for r in keep_one(docs).collect()} == want


def test_joining_equals_all_pairs():
    rng = np.random.default_rng(10)
    for sides, roots in ((1, 60), (2, 60), (1, 9), (2, 9)):
        base = [rng.integers(0, 1 << 63, 60).astype(np.uint64) for _ in range(4)]
        sets = [np.unique(np.concatenate([b[rng.random(60) < 0.93], rng.integers(0, 1 << 63, 3).astype(np.uint64)])) for b in base for _ in range(15)]
        node, root, side = np.arange(60) + 7, rng.integers(0, roots, 60), rng.integers(0, sides, 60)
        found = similar.joining(node, root, side, sets, 80)

        def groups(edges, root=root):
            label = root.copy()
            for i, j in edges:
                label[label == label[j]] = label[i]
            return {tuple(np.flatnonzero(label == x)) for x in label}

        links = [(i, j) for i in range(60) for j in range(i) if (sides == 1 or side[i] != side[j]) and 10 * len(
            np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))]
        assert groups([(a - 7, b - 7) for a, b in found]) == groups(links) and len(found) < 60


def test_rows_made_of_many_near_copies(spark, monkeypatch):
    """What the sets of a group give is in proportion to their number, also where most of their pairs may be alike and few are linked by hubs."""
    rng, made, members = np.random.default_rng(11), [], []
    base = [f"hot{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, base, int(rng.integers(1, 4))))) for i in range(400)]
    mapped, saved = similar.mapped, similar.saved

    def counted(df, fn, schema):
        out = mapped(df, fn, schema)
        if schema.startswith("a long, b long"):
            made.append(out.count())
        return out

    def noted(df, label):
        out = saved(df, label)
        if label == "members":
            members.append(out.count())
        return out

    monkeypatch.setattr(similar, "mapped", counted)
    monkeypatch.setattr(similar, "saved", noted)
    docs, want = frame(spark, [(i, t, "en", "a") for i, t in rows]), kept_by_hand(rows)
    for block, held in ((1024, 500_000), (64, 2000)):
        made.clear(), members.clear()
        monkeypatch.setattr(similar, "BLOCK", block)
        if hasattr(similar, "HELD"):
            monkeypatch.setattr(similar, "HELD", held)
        assert {r.doc_id for r in keep_one(docs).collect()} == want
        assert block < 1024 or max(made) <= 2 * members[0], (made, members)


def test_fingerprints_propose_pairs(spark, monkeypatch):
    """The closest copies are found by SimHash and covering LSH, and what these propose is compared like other pairs."""
    rng, rows, asked = np.random.default_rng(12), [], []
    for group in range(20):
        words = [f"g{group}w{rng.integers(1 << 30)}" for _ in range(1500)]
        rows += [(10 * group + copy, " ".join(edited(rng, words, copy))) for copy in range(3)]
    rows += [(1000, "few words"), (1001, None), (1002, ""), (1003, "Few words")]
    links, likely = similar.simhash.links, similar._Texts.likely

    def counted(prints, radius, *more):
        asked.append((prints.count(), radius))
        return links(prints, radius, *more)

    def noted(self, pairs):
        asked.append({(r.a, r.b) for r in pairs.collect()})
        return likely(self, pairs)

    monkeypatch.setattr(similar.simhash, "links", counted)
    monkeypatch.setattr(similar._Texts, "likely", noted)
    assert {r.doc_id for r in keep_one(frame(spark, [(i, t, "en", "a") for i, t in rows])).collect()} == kept_by_hand(rows)
    prints = {i: similar.majority(shingles((t or "").encode())) for i, t in rows}
    assert asked[0] == (len(set(prints.values())), 4)
    near = [(i, j) for i in prints for j in prints if i < j < 1000 and (prints[i] ^ prints[j]).bit_count() <= 4]
    assert len(near) >= 20
    nodes = {i: similar.node_of(shingles((t or "").encode())) for i, t in rows}
    root = {n: n for n in nodes.values()}
    for a, b in asked[1]:
        root = {n: root[a] if r == root[b] else r for n, r in root.items()}
    assert all(root[nodes[i]] == root[nodes[j]] for i, j in near)


def test_odd_rows(spark):
    docs = frame(spark, odd_rows())
    kept = keep_one(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(
        (i is None, i or 0) for i in (1, 3, None, 5, 6, 7, 8, 9, 2**40))  # 6 has a word, as a no-break space is none of ASCII
    assert set(docs.columns) == set(keep_one(docs).columns) and keep_one(frame(spark, [])).count() == 0
