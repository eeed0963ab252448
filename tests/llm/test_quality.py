from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tablehaul.llm.quality import FEATURES, as_expression, covers, judge, keep_good, learn, text_stats
from tests.llm.helpers import WORD, frame, odd_rows


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts():
    texts = ["a b c d e a b c d e", "a a a a a a", "a a a a a", "# * $ % & | < >\n# * $ % & | < >", "x\x0by\x1cz \u2003 w", "É\nÉ\n\n \n", "ab\nab\n ab",
             *[t for _, t, *_ in odd_rows()]]
    for text in texts:
        assert text_stats(text)[:5] == by_hand(text)


def test_odd_rows_without_labels(spark):
    labels = spark.createDataFrame([(1, None), (None, 0), (2, 7)], "doc_id long, quality int")
    got = judge(frame(spark, odd_rows()), labels).collect()
    assert len(got) == len(odd_rows())
    texts = Counter((i, by_hand(t)) for i, t, *_ in odd_rows())
    assert Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == texts
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed)
    assert judge(frame(spark, []), labels).count() == 0


def test_learned_rules_reject_and_keep(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(240):
        words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(40)]
        bad = i % 4 == 0
        rows.append((i, " ".join(w + "###" if bad else w for w in words), "en", "a"))
        if i < 160:
            labels.append((i, 0 if bad else 1))
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = frame(spark, rows)
    got = {r.doc_id: r.kept for r in judge(docs, labels).collect()}
    assert got == {i: i % 4 != 0 for i in range(240)}
    kept = keep_good(docs.unionByName(docs.limit(1)), labels)
    assert kept.columns == docs.columns and kept.count() == 180


def test_list_is_ordered_and_says_the_same_as_its_expression(spark):
    rng = np.random.default_rng(5)
    n = 2000
    raw = {c: rng.integers(1, 60, n) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
                                               "n_marks", "n_distinct_words")}
    frame_ = spark.createDataFrame(list(zip(*(v.tolist() for v in raw.values()), strict=True)), ", ".join(f"{c} long" for c in raw))
    table = frame_.select("*", *[F.expr(f"double({e})").alias(f"f_{f}") for f, e in FEATURES.items()]).toPandas()
    x = {f: table[f"f_{f}"].to_numpy() for f in FEATURES}
    bad = (x["symbols_per_word"] > 2) | ((x["upper_share"] > 3) & (x["chars_per_word"] < 1))
    rules = learn(x, bad)
    assert len(rules) >= 2
    said = ~np.logical_or.reduce([covers(r, x, n) for r in rules])
    assert (said == ~bad).mean() > 0.97
    assert [r[0] for r in frame_.select(as_expression(rules)).collect()] == said.tolist()
    assert learn(x, np.zeros(n, bool)) == []
