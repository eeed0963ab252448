import numpy as np
import pytest
import xxhash

from tablehaul.llm.components import components
from tablehaul.llm.simhash import BITS, fingerprint, keep_one, links, masks, near_duplicates
from tests.llm.helpers import WORD, frame, odd_rows


def by_hand(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_fingerprints():
    for text in ["", "One", "one TWO three", "ÀB c d e", "a b c d\x1ce f", *[t for i, t, *_ in odd_rows() if i != 5]]:
        assert fingerprint(None if text is None else text.encode()) == by_hand(text)


def test_masks_cover_every_difference():
    rng = np.random.default_rng(1)
    for used in (0, (1 << 40) - 1, int(rng.integers(1 << 62)) & ~((1 << 20) - 1)):
        table = np.array(masks(used, 4), np.uint64)
        open_ = [b for b in range(BITS) if not used >> b & 1]
        for _ in range(3000):
            flips = np.uint64(sum(1 << int(b) for b in rng.choice(open_, 4, replace=False)))
            assert (table & flips == 0).any()
        assert len(set(table.tolist())) > 1 and 0 not in table


@pytest.mark.parametrize("limit", [4096, 6])
def test_links_lose_no_component(spark, limit):
    rng = np.random.default_rng(2)
    prints = set()
    for _ in range(60):
        at = int(rng.integers(0, 1 << 63))
        for _ in range(6):
            at ^= sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 7)), replace=False))
            prints.add(at)
    prints = np.array(sorted(prints), np.uint64)
    pairs = [(int(a), int(b)) for i, a in enumerate(prints) for b in prints[i + 1:][np.bitwise_count(prints[i + 1:] ^ a) <= 4]]
    signed = {int(p): int(p.view(np.int64)) for p in prints}
    df = spark.createDataFrame([(signed[int(p)],) for p in prints], "print long")
    found = links(df, bucket_limit=limit).collect()
    assert classes(signed.values(), [(signed[a], signed[b]) for a, b in pairs]) == classes(signed.values(), [tuple(r) for r in found])


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (500, 500)]
    edges += [tuple(map(int, e)) for e in rng.integers(2000, 2300, (200, 2))]
    expected = classes({n for e in edges for n in e}, edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {n: r for n, r in expected.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    base = [f"alpha{i}" for i in range(400)]
    rows = odd_rows() + [(50 + i, " ".join(base[:i * 7] + [f"new{i}"] + base[i * 7 + 1:]), "en", "a") for i in range(5)]
    docs = frame(spark, rows)
    got = near_duplicates(docs).collect()
    prints = [(i, by_hand(t) if i != 5 else fingerprint(t.encode())) for i, t, *_ in rows]
    edges = [(m, n) for m, (_, a) in enumerate(prints) for n, (_, b) in enumerate(prints) if m < n and (a ^ b).bit_count() <= 4]
    group = classes(range(len(prints)), edges)
    least = {g: min((prints[m][0] for m in group if group[m] == g and prints[m][0] is not None), default=None) for g in group.values()}
    expected = sorted((str(i), format(p, "016x"), str(least[group[m]])) for m, (i, p) in enumerate(prints))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    kept = keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group.values()))
    assert near_duplicates(frame(spark, [])).count() == 0 and keep_one(frame(spark, [])).count() == 0
