import itertools
import re
import zlib
from collections import Counter

import numpy as np

from tablehaul.llm.spelling import Tree, counts, inserted, letters, replaced, spelling_variants, _packed, _signed
from tests.llm.helpers import frame, odd_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(rows):
    n = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def invented(seed, docs=300, stems=60):
    rng = np.random.default_rng(seed)
    alphabet = list("abcdeéß×")
    base = ["".join(rng.choice(alphabet, rng.integers(5, 11))) for _ in range(stems)]
    rows = []
    for i in range(docs):
        text = []
        for w in rng.choice(base, 200, p=(p := 1.0 / np.arange(1, stems + 1)) / p.sum()):
            if rng.random() < 0.3:
                at, letter = rng.integers(len(w)), rng.choice(alphabet)
                w = [w[:at] + w[at + 1:], w[:at] + letter + w[at + 1:], w[:at] + letter + w[at:]][rng.integers(3)]
            text.append(str(w).upper() if rng.random() < 0.1 else str(w))
        rows.append((i * 37, rng.choice([" ", ", ", "1"]).join(text)))
    return rows


def test_edits():
    a, b = ["abcdefghi", "abcdefghj", "bacdefghi"], ["abcdefghij", "aabcdefghi", "abcdefghhi", "xbcdefghii"]
    x, y = letters(a), letters(b)
    assert set(zip(*(z.tolist() for z in inserted(x, y, _signed(x), _signed(y))), strict=True)) == {
        (i, j) for i in range(3) for j in range(4) if one_edit(a[i], b[j])}
    assert set(zip(*(z.tolist() for z in replaced(_packed(x), _packed(x))), strict=True)) == {
        (i, j) for i in range(3) for j in range(3) if one_edit(a[i], a[j])}


def test_trees_reach_all_that_is_near():
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 103, (900, 7)).astype(np.uint8)
    for tight in (True, False):
        tree = Tree(rows, 20, tight)
        points = counts(rows, tree.chosen)
        assert len(tree.rows) > 20 and (np.sort(np.concatenate(tree.rows)) == np.arange(900)).all()
        placed = tree.place(points)
        met = np.zeros((900, len(tree.rows)), bool)
        for leaf, mine in tree.reached(points, 1, 1):
            met[mine, leaf] = True
        near = (np.maximum(points[None] - points[:, None], 0).sum(2) <= 1)
        for i, j in zip(*np.nonzero(near), strict=True):
            assert met[i, placed[j]]
        assert met.mean() < 0.9


def test_against_all_pairs(spark):
    rows = invented(1) + [(9001, "chainxyz " * 200 + "chainxyw " * 40 + "chainxvw " * 8 + "chainxv " * 39)]
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows])
    want = by_hand(rows)
    assert len(want) > 300 and any(r[1] for r in want) and any(r[2] != r[1] for r in want if r[1])
    assert got(spelling_variants(docs)) == want
    # Cells of few words, with trees grown from a small sample, and cells dealt to several blocks.
    assert got(spelling_variants(docs, words_per_cell=20, sampled=200)) == want
    assert got(spelling_variants(docs, words_per_cell=20, sampled=30)) == want


def test_words_of_the_same_letters(spark):
    rows = [(1, " ".join(["".join(p) for p in itertools.permutations("abcdef")][:400] * 5)), (2, "bcdefa " * 30)]
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows])
    assert got(spelling_variants(docs, words_per_cell=16)) == by_hand(rows)


def test_a_repeated_row_counts_as_often(spark):
    rows = [(7, "colour flavour")] * 5000 + [(8, "color flavor colours")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(spelling_variants(docs)) == by_hand(rows)


def test_odd_rows(spark):
    long = "ab" * 100_000
    rows = odd_rows() + [(20, " ".join([long] * 5 + [long + "c"] * 30), "en", "a"), (None, "hidden " * 5, "en", "a")]
    assert got(spelling_variants(frame(spark, rows))) == by_hand([r[:2] for r in rows])
    empty = frame(spark, [])
    assert spelling_variants(empty).count() == 0 and spelling_variants(empty).columns == ["word", "form", "root", "n", "n_near", "form_n"]
