"""Secret scans: patterns propose candidates, a random forest removes the false ones.

The forest looks at a candidate's length and classes of characters, at how likely its character transitions are in the
corpus, at how much of it corpus words cover, at where it stands (the source's path) and at the words beside it. The
counts behind two of these come from all documents; the forest itself is trained on a bounded sample of labelled findings.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import least_hashed, mapped, saved, ship, text_hash
from tablehaul.llm.forest import Forest

#: Corpus words that the dictionary holds (the most frequent), and words a task counts before it passes counts on.
DICTIONARY, HELD_WORDS = 20_000, 200_000

_KEYWORD = re.compile(r"passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential", re.I)
_SAMPLE = re.compile(r"example|sample|dummy|placeholder|your|xxxx|test|fake|changeme", re.I)
_ASSIGNED = re.compile(r"([\w.\-]*(?:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)[\w.\-]*)"
                       r"[ \t]*(?:=|:)[ \t]*[\"']?([^\s\"']{6,})", re.I)
_RUN = re.compile(r"(?<!\S)\S{16,}")
_INNER = re.compile(r"[A-Za-z0-9+/_\-]{16,}={0,2}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)", re.S)
# Published forms of credentials (fixed values): cloud access key ids, code host, chat and payment tokens, web tokens.
_KNOWN_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "sk_live_", "AIza", "eyJ")
_KNOWN = re.compile(r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[0-9A-Za-z\-]{10,}|sk_live_[0-9A-Za-z]{24,}"
                    r"|AIza[0-9A-Za-z_\-]{35}|eyJ[\w\-]{8,}\.eyJ[\w\-]{8,}\.[\w\-]*)(?![A-Za-z0-9])")
_RANDOM_VALUE = re.compile(r"(?=[^\d]*\d)(?=[^a-z]*[a-z]|[^A-Z]*[A-Z])[A-Za-z0-9+/_\-]{12,}={0,2}")

#: Rules whose findings need no second look: their form says what they are.
CERTAIN = ("key_block", "published")

FEATURES = ("length", "digits", "upper", "lower", "others", "distinct", "class_changes", "transitions", "rarest_transition",
            "dictionary", "assigned", "keyword", "sample_word", "path_sample", "hex", "longest_letters")


@dataclass(frozen=True)
class Finding:
    start: int
    end: int
    rule: str
    value: str
    before: str
    after: str


def candidates(text: str | None) -> list[Finding]:
    """Candidates of a whole text in order, without overlap: key blocks and published forms, wherever in the text they stand; in what
    is left of it values assigned to telling names, and long runs."""
    if not text:
        return []
    spans: list[tuple[int, int, str]] = []
    if "-----BEGIN" in text:
        spans += [(m.start(), m.end(), "key_block") for m in _PEM.finditer(text)]
    rest = _blanked(text, spans)
    if any(start in rest for start in _KNOWN_STARTS):
        published = [(m.start(), m.end(), "published") for m in _KNOWN.finditer(rest)]
        rest = _blanked(rest, published)
        spans += published
    if "=" in rest or ":" in rest:
        spans += [(m.start(2), m.end(2), "assigned") for m in _ASSIGNED.finditer(rest)]
    for run in _RUN.finditer(rest):
        for m in _INNER.finditer(run.group()):
            value = m.group()
            if len(value) >= 20 or any(c.isdigit() for c in value):
                spans.append((run.start() + m.start(), run.start() + m.end(), "run"))
    out, last = [], 0
    for start, end, rule in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= last:
            while rule == "assigned" and end - start > 6 and text[end - 1] in ".,;)":
                end -= 1
            out.append(Finding(start, end, rule, text[start:end], text[max(0, start - 40):start], text[end:end + 40]))
            last = end
    return out


def _blanked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with blanks in place of what has been found."""
    parts, last = [], 0
    for start, end, _ in spans:
        parts += [text[last:start], " " * (end - start)]
        last = end
    return "".join([*parts, text[last:]]) if spans else text


@dataclass
class Corpus:
    """Log probabilities of one lower-case byte after another, and frequent words, over all documents."""

    transitions: np.ndarray
    words: frozenset[str]

    def features(self, f: Finding, path: str | None) -> list[float]:
        value, n = f.value, len(f.value)
        digits, upper, lower = (sum(map(t, value)) / n for t in (str.isdigit, str.isupper, str.islower))
        kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in value]
        raw = np.frombuffer(value.lower().encode("utf-8", "replace"), np.uint8)
        steps = self.transitions[raw[:-1], raw[1:]] if len(raw) > 1 else np.zeros(1)
        letters = re.findall(r"[^\W\d_]+", value)
        return [n, digits, upper, lower, 1 - digits - upper - lower, len(set(value)) / n,
                sum(a != b for a, b in zip(kinds[1:], kinds, strict=False)) / n, float(steps.mean()), float(np.quantile(steps, 0.1)),
                self.covered(value.lower()) / n, float(f.rule == "assigned"), float(bool(_KEYWORD.search(f.before))),
                float(bool(_SAMPLE.search(value) or _SAMPLE.search(f.before[-20:]))), float(bool(path and _SAMPLE.search(path))),
                float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))), max(map(len, letters), default=0) / n]

    def covered(self, value: str) -> int:
        """Characters that the longest words of the dictionary cover, from left to right."""
        at = total = 0
        while at < len(value):
            for size in range(min(16, len(value) - at), 2, -1):
                if value[at:at + size] in self.words:
                    at, total = at + size, total + size
                    break
            else:
                at += 1
        return total


def _counts(batches):
    """A task's counts of words and of neighbouring bytes, passed on whenever too many words are held."""
    words, pairs = Counter(), np.zeros(65536, np.int64)

    for batch in batches:
        for text in batch.column(0).to_pylist():
            raw = (text or "").lower().encode("utf-8", "surrogatepass")
            codes = np.frombuffer(raw, np.uint8).astype(np.int64)
            if len(codes) > 1:
                pairs += np.bincount(codes[:-1] * 256 + codes[1:], minlength=65536)
            words.update(raw.split())
        if len(words) > HELD_WORDS:
            yield _words(words)
    yield _words(words)
    at = np.flatnonzero(pairs)
    yield pa.RecordBatch.from_arrays([pa.array([None] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(pairs[at])],
                                     ["word", "pair", "n"])


def _words(words: Counter) -> pa.RecordBatch:
    """The counted words of letters, as text, at least three long; empties the counter."""
    items = [(t, n) for w, n in words.items() if (t := w.decode("utf-8", "replace").strip(".,;:!?")).isalpha() and len(t) > 2]
    words.clear()
    return pa.RecordBatch.from_arrays([pa.array([t for t, _ in items], pa.string()), pa.array([-1] * len(items), pa.int32()),
                                       pa.array([n for _, n in items], pa.int64())], ["word", "pair", "n"])


def corpus(docs: DataFrame, text: str = "text") -> Corpus:
    """Counts over all whole texts. Of the words, the ``DICTIONARY`` most frequent come to the driver; of the pairs, at most
    65536 sums do."""
    counted = saved(mapped(docs.select(F.col(text).cast("string").alias("text")), _counts, "word string, pair int, n long")
                    .groupBy("word", "pair").agg(F.sum("n").alias("n")), "corpus_counts")
    words = counted.filter("word is not null").orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word").collect()
    pairs = np.full(65536, 0.5)
    for row in counted.filter("word is null").select("pair", "n").collect():
        pairs[row["pair"]] += row["n"]
    pairs = pairs.reshape(256, 256)
    return Corpus(np.log(pairs / pairs.sum(axis=1, keepdims=True)), frozenset(r["word"] for r in words))


def known_label(f: Finding) -> int | None:
    """What published forms say of a finding: 1 for them and for mixed values assigned to a telling name, 0 for runs of
    letters, for dates and for plain numbers; nothing otherwise."""
    if f.rule in CERTAIN:
        return 1
    if f.rule == "assigned":
        return 1 if _RANDOM_VALUE.fullmatch(f.value) and not _SAMPLE.search(f.value) else 0 if f.value.isalpha() else None
    return 0 if not any(c.isdigit() for c in f.value) or re.fullmatch(r"[\d\-/:.+_=]+", f.value) else None


_ROW = ("key long, text_hash long, start int, length int, rule string, label int, features array<double>")


def findings(docs: DataFrame, known: Corpus, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Every candidate of every whole text with its features, and its label where published forms give one."""
    shared = docs.sparkSession.sparkContext.broadcast(known)  # 20,000 words and 65536 numbers

    def run(batches):
        names = [c.split()[0] for c in _ROW.split(", ")]
        for batch in batches:
            rows = []
            for key_, hash_, path_, text_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(key_, hash_, f.start, f.end - f.start, f.rule, known_label(f), shared.value.features(f, path_))
                         for f in candidates(text_)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return mapped(docs.select(F.col(key).cast("long").alias("key"), text_hash(text), F.col(path).cast("string").alias("path"),
                              F.col(text).cast("string").alias("text")), run, _ROW)


def train(labelled: DataFrame, most_per_class: int = 3000) -> Forest:
    """A forest from labelled findings (label, features): of each class at most ``most_per_class`` with the least hashes of
    their keys and places."""
    parts = [least_hashed(labelled.filter(F.col("label") == c), ["key", "start", "text_hash"], most_per_class)
             .select("label", "features") for c in (0, 1)]
    rows = [r for part in parts for r in part.collect()]
    x = np.array([r["features"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return Forest(x, np.array([r["label"] for r in rows]))


def scan(docs: DataFrame, labelled: DataFrame | None = None, key: str = "doc_id", text: str = "text",
         path: str = "source") -> DataFrame:
    """``key``, start, length (code points), rule, score and secret (score of 0.5 or more) for every candidate.

    ``labelled`` gives findings (key, start, label) to learn from; without it, labels come from published forms of credentials
    and from plain words. Null and empty texts have no candidates; texts and values of any length are judged whole; null keys and
    paths are allowed; repeated rows have findings each; of findings that overlap the published form, then the one that begins
    first, then the longer one counts; a table without candidates, or an empty one, gives no rows; other columns are not read.
    """
    known = corpus(docs, text)
    found = saved(findings(docs, known, key, text, path), "findings")
    forest = train(found if labelled is None else found.drop("label").join(
        labelled.select(F.col(key).alias("key"), F.col("start").cast("int").alias("start"), "label"), ["key", "start"]))
    return judge(found, forest).withColumnRenamed("key", key)


def judge(found: DataFrame, forest: Forest) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for batch in batches:
            features = batch.column("features")
            x = features.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(shared.value.predict(x), pa.float64())],
                                             ["key", "start", "length", "rule", "score"])

    scored = mapped(found.select("key", "start", "length", "rule", "features"), run,
                    "key long, start int, length int, rule string, score double")
    scored = scored.withColumn("score", F.when(F.col("rule").isin(*CERTAIN), 1.0).otherwise(F.col("score")))
    return scored.withColumn("secret", F.col("score") >= 0.5)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; all rows and columns stay. The forest is applied where
    the text is, so texts are not shuffled. Null texts stay null, repeated rows are redacted alike, an empty table gives none."""
    known = corpus(docs, text)
    forest = train(saved(findings(docs, known, key, text, path).filter("label is not null"), "findings"))
    shared = docs.sparkSession.sparkContext.broadcast((known, forest))

    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def cleaned(texts, paths):
        import pandas as pd

        known, forest = shared.value
        out = []
        for text_, path_ in zip(texts, paths, strict=True):
            found = candidates(text_)
            if found:
                scores = forest.predict(np.array([known.features(f, path_) for f in found]))
                parts, last = [], 0
                for f, score in zip(found, scores.tolist(), strict=True):
                    if score >= 0.5 or f.rule in CERTAIN:
                        parts += [text_[last:f.start], mark]
                        last = f.end
                text_ = "".join(parts) + text_[last:]
            out.append(text_)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, cleaned(F.col(text).cast("string"), F.col(path).cast("string")))
