"""Toxicity by a small convolutional text classifier, trained in numpy.

A word's vector is the mean of hashed vectors: of the word, its beginnings and its ends. Filters of width 1, 2 and 3 slide
over the whole text, the highest response of each is kept, and a logistic unit reads them. As a filter's response is a sum
over the words below it, every distinct word is projected once and texts only add and compare rows of numbers.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import least_hashed, mapped, saved, text_hash

WIDTHS = (1, 2, 3)
#: Distinct words that a Python worker keeps projected before it starts anew (about 300 bytes each).
CACHE_WORDS = 150_000
#: Words of texts put through the filters in one go.
CHUNK = 200_000
_WORD = re.compile(r"[^\W_]+")


@dataclass
class Model:
    table: np.ndarray  # hash buckets x dimensions
    filters: list[np.ndarray]  # per width: width x dimensions x filters
    shift: np.ndarray  # of all filters
    weight: np.ndarray
    bias: float
    thresholds: dict[str | None, float]

    def taps(self) -> np.ndarray:
        """All filters' words side by side: dimensions x (sum of widths x filters)."""
        return np.concatenate([f[o] for f in self.filters for o in range(len(f))], axis=1)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


#: Hashed parts of a word: its first 3, 4, 5 and 6 bytes, its last 3 and 4, and all of it.
PARTS = 7


def features(word: str, buckets: int) -> tuple[int, ...]:
    raw = word.encode("utf-8", "surrogatepass")
    crc = zlib.crc32
    first3 = crc(raw[:3])
    first4 = crc(raw[3:4], first3)
    first5 = crc(raw[4:5], first4)
    return (first3 % buckets, first4 % buckets, first5 % buckets, crc(raw[5:6], first5) % buckets,
            crc(raw[-3:], 1) % buckets, crc(raw[-4:], 1) % buckets, crc(raw, 2) % buckets)


class Projected(dict):
    """Numbers of words, and the rows of their projections; row 0 is the padding between texts."""

    def __init__(self, table: np.ndarray, taps: np.ndarray) -> None:
        super().__init__()
        self.table, self.matrix, self.fresh = table, taps, []
        self.rows = np.zeros((1024, taps.shape[1]), np.float32)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self) + 1
        self.fresh.append(features(word, len(self.table)))
        return number

    def project(self) -> np.ndarray:
        if self.fresh:
            mean = self.table[np.array(self.fresh)].mean(axis=1)
            start, end = len(self) - len(self.fresh) + 1, len(self) + 1
            if end > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(end, len(self.rows)), self.rows.shape[1]), np.float32)])
            self.rows[start:end] = mean @ self.matrix
            self.fresh = []
        return self.rows


def responses(rows: np.ndarray, numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray, filters: int,
              places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Highest response of each filter over each text (start to end; padding stands behind), and where it is."""
    out, where, column = [], [], 0
    edges = np.stack([starts, np.maximum(ends, starts + 1)], axis=1).ravel()
    for width in WIDTHS:
        total = np.zeros((len(numbers) - 3, filters), np.float32)
        for offset in range(width):
            total += rows[numbers[offset:len(numbers) - 3 + offset], column:column + filters]
            column += filters
        high = np.maximum.reduceat(total, edges[:-1] if edges[-1] >= len(total) else edges, axis=0)[::2]
        out.append(high)
        if places:
            where.append(np.stack([a + np.argmax(total[a:max(b, a + 1)], axis=0) for a, b in zip(starts, ends, strict=True)]))
    return np.concatenate(out, axis=1), np.concatenate(where, axis=1) if places else None


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts' word numbers one after the other, three rows of padding behind each; their starts and ends."""
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths + 3) - lengths - 3
    numbers = np.zeros(int((lengths + 3).sum()) + 4, np.int64)
    for start, text in zip(starts, texts, strict=True):
        numbers[start:start + len(text)] = text
    return numbers, starts, starts + lengths


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(texts: list[str], toxic: np.ndarray, langs: list[str | None], buckets: int = 1 << 15, dims: int = 16,
          filters: int = 12, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 11) -> Model:
    """Adam on the logistic loss, both classes weighing the same. A fifth of the rows is left out of training: on it the
    thresholds by language are set. With one class only, or no rows, every score is the share of toxic rows."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    held, used = order[::5], np.setdiff1d(order, order[::5], assume_unique=True)
    y = toxic.astype(np.float32)
    empty = Model(np.zeros((1, dims), np.float32), [np.zeros((w, dims, filters), np.float32) for w in WIDTHS],
                  np.zeros(len(WIDTHS) * filters, np.float32), np.zeros(len(WIDTHS) * filters, np.float32),
                  0.0 if not len(texts) else float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), {})
    if not len(used) or len(set(y[used])) < 2:
        return empty
    vocabulary: dict[str, int] = {}
    numbered = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(t)], np.int64) for t in texts]
    of_word = np.array([(0,) * PARTS, *[features(w, buckets) for w in vocabulary]])
    table = rng.normal(0, 0.1, (buckets, dims)).astype(np.float32)
    # The first dimension starts as a bucket's log odds of standing in a toxic text; training goes on from there.
    seen = np.zeros((2, buckets))
    for i in used:
        if len(numbered[i]):
            seen[int(y[i]), np.unique(of_word[np.unique(numbered[i])])] += 1
    rates = (seen + 0.5) / (np.array([(y[used] == 0).sum(), (y[used] == 1).sum()])[:, None] + 1)
    table[:, 0] = np.clip(np.log(rates[1] / rates[0]), -3, 3) * (seen.sum(0) > 0)
    banks = [rng.normal(0, 0.3 / w, (w, dims, filters)).astype(np.float32) for w in WIDTHS]
    shift, weight = np.zeros(len(WIDTHS) * filters, np.float32), rng.normal(0, 0.3, len(WIDTHS) * filters).astype(np.float32)
    bias = np.zeros(1, np.float32)
    parameters = [table, *banks, shift, weight, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    balance = np.where(y == 1, 0.5 / max(1e-9, y[used].mean()), 0.5 / max(1e-9, 1 - y[used].mean()))
    parts, step = [], 0
    for part in np.array_split(rng.permutation(used), max(1, len(used) // batch)):
        numbers, starts, ends = laid_out([numbered[i] for i in part])
        words, local = np.unique(numbers, return_inverse=True)
        parts.append((part, local, starts, ends, of_word[words], (words > 0)[:, None]))
    for _ in range(epochs):
        for part, local, starts, ends, hashed, real in [parts[i] for i in rng.permutation(len(parts))]:
            step += 1
            vectors = table[hashed].mean(axis=1) * real
            taps = np.concatenate([f[o] for f in banks for o in range(len(f))], axis=1)
            high, where = responses(vectors @ taps, local, starts, ends, filters, places=True)
            pooled = np.maximum(high + shift, 0)
            score = sigmoid(pooled @ weight + bias[0])
            wrong = ((score - y[part]) * balance[part] / len(part)).astype(np.float32)
            back = wrong[:, None] * weight * (pooled > 0)
            slopes = [np.zeros_like(b) for b in banks]
            on_word = np.zeros_like(vectors)
            for k, width in enumerate(WIDTHS):
                mine, at = back[:, k * filters:(k + 1) * filters], where[:, k * filters:(k + 1) * filters]
                for offset in range(width):
                    which = local[at + offset]
                    slopes[k][offset] = np.einsum("bfd,bf->df", vectors[which], mine)
                    np.add.at(on_word, which.ravel(), (mine[:, :, None] * banks[k][offset].T[None]).reshape(-1, dims))
            on_table = np.zeros_like(table)
            touched = np.flatnonzero(np.abs(on_word).sum(1) * real[:, 0])
            np.add.at(on_table, hashed[touched].ravel(), np.repeat(on_word[touched] / PARTS, PARTS, axis=0))
            slope = [on_table, *slopes, back.sum(0), pooled.T @ wrong, np.array([wrong.sum()], np.float32)]
            for p, g, (m, v) in zip(parameters, slope, moments, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model = Model(table, banks, shift, weight, float(bias[0]), {})
    model.thresholds = calibrate(Scorer(model).scores([texts[i] for i in held]), toxic[held].astype(bool), [langs[i] for i in held])
    return model


def calibrate(scores: np.ndarray, toxic: np.ndarray, langs: list[str | None], least: int = 20) -> dict[str | None, float]:
    """For each language with ``least`` rows of both kinds together, the threshold of the highest F1, in the middle of the
    range that reaches it; other languages keep 0.5."""
    out = {}
    for lang in set(langs):
        mine = np.array([x == lang for x in langs])
        s, t = scores[mine], toxic[mine]
        if mine.sum() < least or not t.any() or t.all():
            continue
        by = np.argsort(-s, kind="stable")
        hits = np.cumsum(t[by])
        f1 = 2 * hits / (np.arange(1, len(by) + 1) + t.sum())
        cut = int(np.argmax(np.where(np.append(s[by][1:] < s[by][:-1], True), f1, -1)))
        out[lang] = float((s[by][cut] + (s[by][cut + 1] if cut + 1 < len(by) else 0.0)) / 2)
    return out


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.taps = model, model.taps()
        self.words = Projected(model.table, self.taps)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out, waiting, held = [], [], 0
        for text in texts:
            waiting.append(np.fromiter(map(self.words.__getitem__, words_of(text)), np.int64))
            held += len(waiting[-1])
            if held > CHUNK:
                out.append(self.run(waiting))
                waiting, held = [], 0
        if waiting:
            out.append(self.run(waiting))
        return np.concatenate(out) if out else np.zeros(0)

    def run(self, numbered: list[np.ndarray]) -> np.ndarray:
        numbers, starts, ends = laid_out(numbered)
        high, _ = responses(self.words.project(), numbers, starts, ends, self.model.filters[0].shape[2])
        if len(self.words) > CACHE_WORDS:
            self.words = Projected(self.model.table, self.taps)
        return sigmoid(np.maximum(high + self.model.shift, 0).astype(np.float64) @ self.model.weight + self.model.bias)


def held_out(key: str = "doc_id"):
    """Whether a row's label must not be learned from: crc32 of the key as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most_per_class: int = 1500, key: str = "doc_id", text: str = "text",
        lang: str = "lang", label: str = "toxic") -> Model:
    """Train on at most ``most_per_class`` labelled rows of each class that are not held out, those with the least hashes
    of their keys. Only they, with whole texts, come to the driver. Of repeated rows one is learned from; several rows
    of one key count each; labels other than 0 and 1, and null keys, are left out."""
    marked = labels.select(F.col(key).cast("long").alias("_key"), F.col(label).cast("int").alias("_toxic")).filter(
        F.col("_toxic").isin(0, 1) & ~held_out("_key")).distinct()
    chosen = [least_hashed(marked.filter(F.col("_toxic") == c), ["_key"], most_per_class) for c in (0, 1)]
    own = docs.select(F.col(key).cast("long").alias("_key"), text_hash(text).alias("_hash"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    # An id may stand for many rows: these are bounded as well, once they are known.
    held = saved(own.select("_key", "_hash").join(F.broadcast(chosen[0].unionByName(chosen[1])), "_key").distinct(), "labelled")
    bounded = [least_hashed(held.filter(F.col("_toxic") == c), ["_key", "_hash"], most_per_class) for c in (0, 1)]
    rows = own.join(F.broadcast(bounded[0].unionByName(bounded[1])), ["_key", "_hash"]).dropDuplicates(["_key", "_hash", "_toxic"])
    rows = rows.toPandas().sort_values(["_key", "_text"])
    return train(rows["_text"].tolist(), rows["_toxic"].to_numpy(), rows["_lang"].tolist())


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``key``, held_out, score, predicted (1 from a score of 0.5), and flagged: the score reaches its language's
    threshold. The score depends on the text alone, whole; null and empty texts have the score of no words. Null keys are not
    held out, repeated rows are scored alike, an empty table gives no rows, and other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the number of rows

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = scorer.scores(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                                             ["key", "lang", "score"])

    scored = mapped(docs.select(F.col(key).cast("long").alias("key"), F.col(lang).cast("string").alias("lang"),
                                F.col(text).cast("string").alias("text")), run, "key long, lang string, score double")
    threshold = F.lit(0.5)
    for name, value in sorted((k, v) for k, v in model.thresholds.items() if k is not None):
        threshold = F.when(F.col("lang") == name, F.lit(value)).otherwise(threshold)
    return scored.select(F.col("key").alias(key), held_out("key").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         (F.col("score") >= threshold).alias("flagged"))
