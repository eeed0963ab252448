"""Quality rules: decision lists learned by sequential covering from labelled statistics of texts.

One pass counts statistics of every whole text. From a bounded sample of labelled rows, rules for the bad class are grown one
after the other: conditions on thresholds are added while they raise the information gain, then pruned on rows held
back, and the rows a rule covers are set aside. The list is handed to Spark as one conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import least_hashed, mapped, rows_of, saved, text_hash

#: Characters that count as symbols, and the width of the windows whose repeats are counted (fixed by the contract).
SYMBOLS = "#*$%&|<>"
WINDOW = 5
_STATS = ("key long, text_hash long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_lines long, n_upper long, n_marks long, n_distinct_words long")

#: What rules may ask about, from the counted statistics; every one is 0 for a text without words.
FEATURES = {
    "n_words": "n_words",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
}


def repeated_words(words: list[bytes], ids: dict[bytes, int]) -> int:
    """Words that lie in a window of five found twice or more in the text, its first place included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.int64, len(words))
    view = np.lib.stride_tricks.sliding_window_view(codes, WINDOW)
    key = np.zeros(n, np.uint64)
    for column in range(WINDOW):
        key = (key ^ view[:, column].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    left, right = order[:-1][same], order[1:][same]
    if (view[left] != view[right]).any():  # two windows share a hash: compare the windows themselves
        _, place, count = np.unique(view, axis=0, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[place.ravel()] > 1)
    else:
        starts = np.union1d(left, right)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum())


def text_stats(text: str | None, ids: dict[bytes, int] | None = None) -> tuple[int, ...]:
    """The statistics of one whole text, in the order of the columns after the key."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen, lines, repeated = set(), 0, 0
    for line in text.split("\n"):
        if line.strip("\t\v\f\r "):
            lines += 1
            repeated += line in seen
            seen.add(line)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.bincount(np.minimum(points, 255), minlength=256)
    return (len(words), len(text) - int(counts[_BLANK].sum()), int(counts[_SYMBOL].sum()), repeated,
            repeated_words(words, {} if ids is None else ids), lines, int(counts[_UPPER].sum()),
            int(counts[[33, 63]].sum()), len(set(words)))


_BLANK = [9, 10, 11, 12, 13, 32]
_SYMBOL = [ord(c) for c in SYMBOLS]
_UPPER = [*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]


def _stats(batches):
    names = [c.split()[0] for c in _STATS.split(", ")]
    for batch in batches:
        rows = [text_stats(t) for t in batch.column(2).to_pylist()]
        columns = zip(*rows, strict=True) if rows else [[]] * (len(names) - 2)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(c, pa.int64()) for c in columns]], names)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts per row of ``docs``, from its whole text; a null text counts as empty."""
    return mapped(docs.select(F.col(key).cast("long").alias("key"), text_hash(text), F.col(text).cast("string").alias("text")),
                  _stats, _STATS)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    return np.logical_and.reduce([np.ones(n, bool), *[c.holds(x) for c in rule]])


def _best_condition(x: dict[str, np.ndarray], y: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the highest information gain: at each change of value, taken half-way, both directions."""
    total_p, total = int(y.sum()), len(y)
    base, best, chosen = np.log2(total_p / total), 1e-9, None
    for feature in FEATURES:
        order = np.argsort(x[feature], kind="stable")
        values, hits = x[feature][order], np.cumsum(y[order])
        cut = np.flatnonzero(values[1:] > values[:-1])
        if not len(cut):
            continue
        below_p, below = hits[cut], cut + 1
        for above, p, n in ((False, below_p, below), (True, total_p - below_p, total - below)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - base), -np.inf)
            at = int(np.argmax(gain))
            if gain[at] > best + 1e-9:
                best = float(gain[at])
                chosen = Condition(feature, above, float((values[cut[at]] + values[cut[at] + 1]) / 2))
    return best, chosen


def grow(x: dict[str, np.ndarray], bad: np.ndarray, most_conditions: int = 6) -> Rule:
    """Add the best condition until no good row is covered or nothing is gained."""
    rule, inside = (), np.ones(len(bad), bool)
    while len(rule) < most_conditions and (inside & ~bad).any() and (inside & bad).any():
        _, condition = _best_condition({k: v[inside] for k, v in x.items()}, bad[inside])
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(x)
    return rule


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule with the best (bad - good) / (bad + good) on rows that did not grow it."""
    best, kept = -1.0, rule[:1]
    for n in range(1, len(rule) + 1):
        inside = covers(rule[:n], x, len(bad))
        p, q = (inside & bad).sum(), (inside & ~bad).sum()
        worth = (p - q) / (p + q) if p + q else -1.0
        if worth > best + 1e-12:
            best, kept = worth, rule[:n]
    return kept


def learn(x: dict[str, np.ndarray], bad: np.ndarray, least_precision: float = 0.9, least_rows: int = 3,
          most_rules: int = 16) -> list[Rule]:
    """Sequential covering: ordered rules for the bad class, each of at least ``least_precision`` on the rows left to it.

    Every third row is held back for pruning. Rows with equal values fall on either side of a threshold together. No
    rules come of rows of one class only.
    """
    rules, left = [], np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < most_rules and (left & bad).sum() >= least_rows:
        part, held = left & ~third, left & third
        rule = grow({k: v[part] for k, v in x.items()}, bad[part])
        if not rule:
            break
        rule = prune(rule, {k: v[held] for k, v in x.items()}, bad[held]) if (held & bad).any() else rule
        inside = covers(rule, x, len(bad)) & left
        if (inside & bad).sum() < max(least_rows, least_precision * inside.sum()):
            break
        rules.append(rule)
        left &= ~inside
    return rules


def as_expression(rules: list[Rule]) -> Column:
    """The list as one conditional expression over the statistics: false where the first matching rule is, else true."""
    if not rules:
        return F.lit(True)
    cases = " ".join(f"WHEN {' AND '.join(map(str, rule))} THEN false" for rule in rules)
    return F.expr(f"CASE {cases} ELSE true END")


def base_failed(least_words: int = 10, most_repeat_percent: int = 20) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat_percent * F.col("n_words"))


def learn_rules(stats: DataFrame, labels: DataFrame, most_labelled: int = 20_000, key: str = "doc_id",
                label: str = "quality") -> list[Rule]:
    """Rules from labelled rows (``label`` 0: bad, 1: good; others and null keys are passed over).

    At most ``most_labelled`` labelled rows, those with the least hashes of their keys, come to the driver with their
    counts. Rows that the base rule fails are left out, as no learned rule is asked about them.
    """
    marked = labels.select(F.col(key).cast("long").alias("key"), F.col(label).alias("_label")).filter(
        F.col("_label").isin(0, 1))
    labelled = saved(stats.filter(~base_failed()).join(marked, "key").select(
        "key", "text_hash", "_label", *[F.expr(f"double({e})").alias(f) for f, e in FEATURES.items()]), "labelled")
    found = least_hashed(labelled, ["key", "text_hash", "_label"], most_labelled).toPandas()
    x = {f: found[f].to_numpy(float) for f in FEATURES}
    return learn(x, (found["_label"] == 0).to_numpy()) if len(found) else []


def judge(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``key``, the counts, base_failed and kept (both boolean) for every row of ``docs``, with the text's hash.

    Null and empty texts have no words and so fail the base rule; texts of any length are counted whole. Repeated rows are judged
    alike, null keys like others (they only cannot be labelled); rows with equal counts have one verdict. Without labels of both classes the base rule alone decides. An empty table gives no
    rows; other columns are not read.
    """
    stats = saved(statistics(docs, key, text), "quality_stats")
    verdict = as_expression(learn_rules(stats, labels, most_labelled, key))
    return stats.select("*", base_failed().alias("base_failed"), (~base_failed() & verdict).alias("kept")) \
        .withColumnRenamed("key", key)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that are judged good; every row by its own text, with or without key.

    Null and empty texts go, repeated rows stay or go together, columns may have any names, an empty table gives no rows."""
    return rows_of(docs, judge(docs, labels, key=key, text=text).filter("kept"), key, text)
