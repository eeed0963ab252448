"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is a vector of letter counts. An inserted or deleted letter moves it by 1 (L1 distance), a replaced one by 2: one letter
gained, one lost. So the words near a word of n letters are among those of n letters whose vectors gain and lose at most one,
and those of n + 1 that gain one and lose none; the pairs with n - 1 are found from the other side.

The words of each length lie in cells of about ``words_per_cell``. A tree grown from a bounded sample says which cell a word
is in and which cells a search has to visit: those whose box is near enough. In a task each cell is a k-d tree with tight boxes of its own,
and the words of its last boxes are compared letter by letter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.blocks import beside
from tablehaul.llm.common import least_hashed, lower_ascii, mapped, saved

#: Stored words, queries that replace a letter, queries that insert one; each with the letters that may be gained and lost.
STORED, REPLACE, INSERT = 0, 1, 2
MOVES = {REPLACE: (1, 1), INSERT: (1, 0)}
#: Words in a tree's last boxes, and letter comparisons held at a time.
BOX, CELLS = 48, 1 << 22


def words(docs: DataFrame, least_letters: int = 6, least_n: int = 5, every: int = 199, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` for every word of at least that many letters that occurs that often in all texts together.

    Counted in the tasks that read the texts before anything is shuffled. Shorter runs cannot become such a word.
    """
    run = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        F.col(text).cast("string"), F.lit(rf"([A-Za-zÀ-ÿ]{{{least_letters},}})"), F.lit(1))).alias("run"))
    run = run.select("id", lower_ascii(F.col("run")).alias("run"))
    hashed = run.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run").cast("long")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.pmod("h", F.lit(every)) == 0, cut).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).where(F.char_length("word") >= least_letters)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n))


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters; all of them are below U+0100."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def counts(rows: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
    """The letter-count vectors of rows of letters, over the ``chosen`` letters with all others counted together at the end."""
    kind, parts = np.int8 if rows.shape[1] < 120 else np.int32, []
    for at in range(0, len(rows), 4096):
        part = rows[at:at + 4096]
        flat = np.bincount((part + np.arange(len(part))[:, None] * 256).ravel(), minlength=256 * len(part)).reshape(-1, 256)
        if chosen is not None:
            known = flat[:, chosen]
            flat = np.column_stack([known, part.shape[1] - known.sum(1)])
        parts.append(flat.astype(kind))
    return np.concatenate(parts)


class Tree:
    """A k-d tree: boxes (least and greatest counts), each split in two at the median of its widest letter.

    ``tight`` boxes are those of the points given; others are the regions that the splits leave, which hold any word.
    """

    def __init__(self, rows: np.ndarray, most: int, tight: bool):
        self.chosen = np.flatnonzero(counts(rows).any(0))
        points = counts(rows, self.chosen)
        width, top = points.shape[1], np.iinfo(points.dtype).max
        self.low, self.high, self.cut, self.rows = [np.zeros(width, points.dtype)], [np.full(width, top, points.dtype)], [None], []
        self.leaf = [0]
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, mine = waiting.pop()
            part = points[mine]
            if tight:
                self.low[node], self.high[node] = part.min(0), part.max(0)
            axis = int(part.var(0).argmax())
            line = part[:, axis]
            at = min(int(np.median(line)), int(line.max()) - 1)
            if len(mine) <= most or line.max() == line.min():
                self.leaf[node] = len(self.rows)
                self.rows.append(mine)
                continue
            left = line <= at
            for side, chosen in ((0, left), (1, ~left)):
                low, high = self.low[node].copy(), self.high[node].copy()
                if side:
                    low[axis] = max(low[axis], at + 1)
                else:
                    high[axis] = min(high[axis], at)
                self.low.append(low)
                self.high.append(high)
                self.cut.append(None)
                self.leaf.append(-1)
                waiting.append((len(self.low) - 1, mine[chosen]))
            self.cut[node], self.leaf[node] = (axis, at, len(self.low) - 2), -1

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out, waiting = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while waiting:
            node, mine = waiting.pop()
            if self.cut[node] is None:
                out[mine] = self.leaf[node]
                continue
            axis, at, first = self.cut[node]
            left = points[mine, axis] <= at
            waiting += [(first, mine[left]), (first + 1, mine[~left])]
        return out

    def reached(self, points: np.ndarray, gain: int, lose: int):
        """Each leaf whose box some points reach by gaining and losing so many letters, with these points."""
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, mine = waiting.pop()
            part = points[mine]
            up = np.maximum(self.low[node] - part, 0).sum(1) <= gain
            down = np.maximum(part - self.high[node], 0).sum(1) <= lose
            mine = mine[up & down]
            if not len(mine):
                continue
            if self.cut[node] is None:
                yield self.leaf[node], mine
            else:
                waiting += [(self.cut[node][2], mine), (self.cut[node][2] + 1, mine)]


def _packed(rows: np.ndarray) -> np.ndarray:
    """Rows of letters as 64-bit integers, eight letters in each."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, :rows.shape[1]] = rows
    return wide.view("<u8")


def _signed(rows: np.ndarray) -> np.ndarray:
    """Sums of 16 to the letter's class: one more letter of a class adds that power, whatever has overflowed."""
    power = np.uint64(1) << (np.arange(256, dtype=np.uint64) % 16 * 4)
    return power[rows].sum(1, dtype=np.uint64)


def replaced(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the packed ``a`` and ``b`` that differ in exactly one letter."""
    ones, differing = np.uint64(0x0101010101010101), np.zeros((len(a), len(b)), np.uint32)
    for k in range(a.shape[1]):
        x = a[:, k, None] ^ b[None, :, k]
        for shift in (4, 2, 1):
            x |= x >> np.uint64(shift)
        differing += np.bitwise_count(x & ones)
    return np.nonzero(differing == 1)


def inserted(a: np.ndarray, b: np.ndarray, signed_a: np.ndarray, signed_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the letters ``a`` that become rows of ``b`` by one more letter."""
    more = signed_b[None, :] - signed_a[:, None]
    i, j = np.nonzero((np.bitwise_count(more) == 1) & (more & np.uint64(0x1111111111111111) != 0))
    keep, step = [], max(1, CELLS // b.shape[1])
    for at in range(0, len(i), step):
        x, y = a[i[at:at + step]], b[j[at:at + step]]
        before = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(1)
        after = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
        keep.append(before + after >= x.shape[1])
    kept = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[kept], j[kept]


def _firsts(of: list[str], near: list[str], near_n: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Of each word that has near ones in these pairs: their number, and the one that occurs most, the least of equals."""
    rank = np.empty(len(near), np.int64)
    rank[sorted(range(len(near)), key=near.__getitem__)] = np.arange(len(near))
    order = np.lexsort((rank[j], -near_n[j], i))
    i, j = i[order], j[order]
    head = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    many = np.diff(np.r_[head, len(i)])
    return pa.RecordBatch.from_arrays([pa.array([of[x] for x in i[head]], pa.string()), pa.array(many),
                                       pa.array(near_n[j[head]]), pa.array([near[x] for x in j[head]], pa.string())],
                                      ["word", "n_near", "best_n", "best"])


class _Cell:
    """The stored words of a cell, all of one length, as a tree."""

    def __init__(self, held: list[pa.RecordBatch]):
        self.words = [w for b in held for w in b.column("word").to_pylist()]
        self.n = np.concatenate([b.column("n").to_numpy() for b in held])
        self.letters = letters(self.words)
        self.packed, self.signed = _packed(self.letters), _signed(self.letters)
        self.tree = Tree(self.letters, BOX, tight=True)


def _search(cell: _Cell, kind: int, piece: pa.RecordBatch):
    asked, asked_n = piece.column("word").to_pylist(), piece.column("n").to_numpy()
    rows = letters(asked)
    packed, signed, found = _packed(rows), _signed(rows), []
    for leaf, mine in cell.tree.reached(counts(rows, cell.tree.chosen), *MOVES[kind]):
        stored = cell.tree.rows[leaf]
        step = max(1, CELLS // len(stored))
        for at in range(0, len(mine), step):
            q = mine[at:at + step]
            i, j = (replaced(packed[q], cell.packed[stored]) if kind == REPLACE
                    else inserted(rows[q], cell.letters[stored], signed[q], cell.signed[stored]))
            if len(i):
                found.append((q[i], stored[j]))
    if found:
        i, j = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        yield _firsts(asked, cell.words, cell.n, i, j)
        if kind == INSERT:  # the longer words do not search for shorter ones
            yield _firsts(cell.words, asked, asked_n, j, i)


def _deal(shared, asking: bool):
    """Each word into its cell, or into the cells that it has to search; a cell is its length and its leaf."""
    def run(batches):
        trees = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                every, n = part.column("word").to_pylist(), part.column("n").to_numpy()
                size = np.fromiter(map(len, every), np.int64, len(every))
                for length in np.unique(size).tolist():
                    mine = np.flatnonzero(size == length)
                    rows = letters([every[i] for i in mine])
                    for kind in (REPLACE, INSERT) if asking else (STORED,):
                        where = length + (kind == INSERT)
                        tree = trees.get(where)
                        if tree is None:
                            hits = [(0, np.arange(len(mine)))]
                        elif asking:
                            hits = tree.reached(counts(rows, tree.chosen), *MOVES[kind])
                        else:
                            leaf = tree.place(counts(rows, tree.chosen))
                            hits = [(x, np.flatnonzero(leaf == x)) for x in np.unique(leaf).tolist()]
                        for leaf, chosen in hits:
                            at_ = mine[chosen]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(at_), (where << 24) + leaf)), pa.array(np.full(len(at_), kind, np.int32)),
                                 pa.array([every[i] for i in at_], pa.string()), pa.array(n[at_])], ["cell", "kind", "word", "n"])

    return run


def near_words(rows: DataFrame, words_per_cell: int = 8192, sampled: int = 100_000) -> DataFrame:
    """Of every word (stored columns word, n) that has near ones: their number, and the most frequent of them with its n.

    At most ``sampled`` words go to the driver, to grow the trees that say which cell is where, and those lengths that have more
    words than a cell. A cell with more than four times its share, as when very many words have the same letters, is dealt to
    several blocks, and the words that search it go to all of them; so no task holds more than about that.
    """
    spark = rows.sparkSession
    sizes = {r["length"]: r["count"] for r in rows.groupBy(F.char_length("word").alias("length")).count().where(
        F.col("count") > words_per_cell).collect()}
    sample: dict[int, list[str]] = {}
    if sizes:
        for r in least_hashed(rows.where(F.char_length("word").isin(list(sizes))).select("word"), ["word"], sampled).collect():
            sample.setdefault(len(r["word"]), []).append(r["word"])
    trees = {length: Tree(letters(some), max(8, math.ceil(words_per_cell * len(some) / sizes[length])), tight=False)
             for length, some in sample.items()}
    shared = spark.sparkContext.broadcast(trees)
    schema = "cell long, kind int, word string, n long"
    stored, asking = mapped(rows, _deal(shared, False), schema), mapped(rows, _deal(shared, True), schema)
    crowded = saved(stored.groupBy("cell").count().where(F.col("count") > 4 * words_per_cell).select(
        "cell", F.ceil(F.col("count") / words_per_cell).cast("int").alias("blocks")), "crowded")
    both = stored.unionByName(asking).join(crowded, "cell", "left")
    many = F.coalesce("blocks", F.lit(1))
    block = F.when(F.col("kind") == STORED, F.array(F.pmod(F.xxhash64("word"), many))).otherwise(
        F.sequence(F.lit(0).cast("long"), many.cast("long") - 1))
    dealt = both.select(F.explode(block).alias("part"), "cell", "kind", "word", "n").select(
        F.xxhash64("cell", "part").alias("block"), "kind", "word", "n")
    tasks = sum(len(t.rows) for t in trees.values()) + 16
    near = beside(dealt.repartition(tasks, "block"), _Cell, _search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.best").alias("best"))


def roots(forms: DataFrame, most_n: int, times: int = 5) -> DataFrame:
    """``word`` and ``root`` for every word that has a form: where the chain of forms ends.

    Every step multiplies n by ``times`` at least, so chains are short; each round doubles the known part of all of them.
    """
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    steps = int(math.log(max(most_n, 1), times)) + 1
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = saved(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return now


def spelling_variants(docs: DataFrame, least_letters: int = 6, least_n: int = 5, every: int = 199, times: int = 5,
                      words_per_cell: int = 8192, sampled: int = 100_000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of at least ``least_letters`` that occurs ``least_n`` times.

    Runs of the letters A to Z and U+00C0 to U+00FF, A to Z in lower case, are the words; where ``every`` divides the crc32 of
    "key:run", one letter is deleted. Words are near at one edit. A word's form is its near word with the largest n, the least
    of equals, if that is at least ``times`` its own n; the root ends the chain of forms.

    Null and empty texts have no words; a null key is written as nothing before the colon. Rows that repeat count as often as
    they are there. Words and texts may be of any length. Other columns are not read; an empty table gives no rows.
    """
    found = saved(words(docs, least_letters, least_n, every, key, text), "words")
    near = near_words(found, words_per_cell, sampled)
    form = F.col("best_n") >= times * F.col("n")
    judged = saved(found.join(near, "word", "left").select(
        "word", F.when(form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form, F.col("best_n")).alias("form_n")), "forms")
    most = judged.agg(F.max("n")).first()[0] or 1
    rooted = roots(judged.where("form IS NOT NULL"), most, times)
    return judged.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
