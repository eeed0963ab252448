import numpy as np

from tablehaul.llm.toxicity import Scorer, calibrate, fit, responses, score, train
from tests.llm.helpers import frame, odd_rows


def corpus(n, seed):
    """Prose of random syllables; bad words stand in some texts, in one language with any ending."""
    rng = np.random.default_rng(seed)
    syllables = ["an", "er", "th", "on", "le", "is", "ou", "re", "in", "st", "ed", "or"]
    texts, toxic = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(20, 120)))]
        bad = i % 4 == 0
        for _ in range(2 if bad else 0):
            words[int(rng.integers(len(words)))] = "vilest" if i % 8 else "qux" + str(rng.choice(syllables))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, np.array(toxic)


def test_held_out_accuracy_and_order_of_texts():
    texts, toxic = corpus(900, 1)
    model = train(texts, toxic, ["en" if i % 8 else "fr" for i in range(900)])
    other, truth = corpus(300, 2)
    scores = Scorer(model).scores(other)
    assert ((scores >= 0.5) == truth).mean() > 0.97 and ((scores >= 0) & (scores <= 1)).all()
    one_by_one = np.concatenate([Scorer(model).scores([t]) for t in other[:20]])
    assert np.allclose(scores[:20], one_by_one, atol=1e-6)
    assert (Scorer(train(texts, toxic, ["en"] * 900)).scores(other) == Scorer(train(texts, toxic, ["de"] * 900)).scores(other)).all()


def test_responses_by_hand():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(9, 12)).astype(np.float32)
    rows[0] = 0
    texts = [[1, 5, 3], [8], [], [2, 2, 7, 4, 6]]
    numbers = np.array([*[1, 5, 3], 0, 0, 0, 8, 0, 0, 0, 0, 0, 0, *[2, 2, 7, 4, 6], 0, 0, 0, 0, 0, 0, 0])
    starts, ends = np.array([0, 6, 10, 13]), np.array([3, 7, 10, 18])
    high, where = responses(rows, numbers, starts, ends, 2, places=True)
    for t, text in enumerate(texts):
        padded, column = (text or [0]) + [0, 0], 0
        for k, width in enumerate((1, 2, 3)):
            values = np.array([sum(rows[padded[i + o], column + 2 * o:column + 2 * o + 2] for o in range(width)) for i in range(len(padded) - 2)])
            assert np.allclose(high[t, 2 * k:2 * k + 2], values.max(0), atol=1e-5)
            assert (where[t, 2 * k:2 * k + 2] - starts[t] == values.argmax(0)).all()
            column += 2 * width


def test_thresholds():
    scores, toxic = np.array([0.9, 0.4, 0.35, 0.1] * 10), np.array([1, 1, 0, 0] * 10).astype(bool)
    assert 0.35 < calibrate(scores, toxic, ["en"] * 40)["en"] < 0.4
    assert calibrate(scores, toxic, [None] * 40)[None] and calibrate(scores[:4], toxic[:4], ["en"] * 4) == {}


def test_odd_rows(spark):
    docs = frame(spark, odd_rows())
    for labels in ([], [(1, 1), (None, 0)], [(1, 1), (4, 0), (9, 0), (8, None), (2, 1)]):
        model = fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = score(docs, model).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        empty = {r.score for r in got if r.doc_id in (3, 4, 6)}
        assert len(empty) == 1
    assert score(frame(spark, []), model).count() == 0


def test_what_is_learned_from_is_bounded(spark, monkeypatch):
    """One labelled key on 5,000 rows."""
    from tablehaul.llm import toxicity

    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, langs: seen.append((texts, toxic)))
    rows = [(1, f"text {i}", "en", "a") for i in range(3000)] + [(1, "the same text", "en", "a")] * 2000 + [(2, "fine", "en", "a")]
    fit(frame(spark, rows), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"), most_per_class=50)
    texts, toxic = seen[0]
    assert len(texts) <= 100 and toxic.sum() == 50 and len(set(texts)) == len(texts)
