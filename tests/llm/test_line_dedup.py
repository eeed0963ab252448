import hashlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from conftest import plan
from tablehaul.llm import line_dedup
from tablehaul.llm.line_dedup import keep_bitmaps, line_digests, without_repeated_lines
from tablehaul.llm.queries import QUERIES
from tests.llm.helpers import frame, odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOLDER = "/root/testdata/sf0.001"


def key_of(line):
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def by_hand(rows):
    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 10:
                place = (i is None, i or 0)
                first[key_of(line)] = min(first.get(key_of(line), place), place)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(key_of(x), (i is None, i or 0)) == (i is None, i or 0)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)


def invented(seed=5):
    rng = np.random.default_rng(seed)
    lines = [f"Line number {i} of those that repeat" for i in range(300)] + ["short", "", " ", "ÀÉ lower-case only A to Z", "àé lower-case only a to z"]
    rows = []
    for i in range(400):
        chosen = [str(x) for x in rng.choice(lines, rng.integers(0, 40))] + [f"own line of document {i}"] * int(rng.integers(0, 3)) + ["a notice that is everywhere"]
        rng.shuffle(chosen)
        rows.append((int(rng.integers(1 << 40)), "\n".join((" \t" + x.upper() + "\r") if rng.random() < 0.2 else x for x in chosen)))
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = invented() + [(1 << 50, "\n".join(f"line {i} of a very long text" for i in range(20_000)) + "\n"),
                         (1 << 51, "\n".join(f"LINE {i} of a very long text" for i in range(0, 20_000, 3)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(line_digests(docs)) == by_hand(rows)
    # Every repeated line is common, and none is.
    monkeypatch.setattr(line_dedup, "LOOKED_AT", 1)
    for common in (1, 1_000_000):
        monkeypatch.setattr(line_dedup, "COMMON", common)
        assert got(line_digests(docs)) == by_hand(rows)


def test_against_sql(spark):
    want = duckdb.sql(line_dedup.SQL.replace("FROM documents", f"FROM '{FOLDER}/documents.parquet'")).fetchall()
    assert got(QUERIES["op12_line_dedup"](spark, FOLDER)) == sorted(want, key=str)


def test_bitmaps_are_compressed(spark):
    lines = [f"a line with the number {i}" for i in range(1000)]
    docs = spark.createDataFrame([(1, "\n".join([lines[3], lines[900]])), (2, "\n".join(lines))], "doc_id long, text string")
    r = keep_bitmaps(docs).collect()
    assert len(r) == 1 and r[0].id == 2 and r[0].n_dropped == 2
    assert [(w.word, w.bits) for w in r[0].keep] == [(0, ~(1 << 3)), (900 // 64, ~(1 << 900 % 64))]


def test_a_row_given_5000_times(spark):
    rows = [(7, "a line that is here twice\na line that is here twice\nx")] * 5000 + [(8, "A LINE that is here twice\ny")] * 3 + [(None, "a line that is here twice")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(line_digests(docs)) == by_hand(rows)


def test_odd_rows(spark):
    rows = odd_rows() + [(30, "no key here\nThe quick brown fox jumps over the lazy dog and runs away from the big bad wolf today ", "en", "a"),
                         (None, "NO KEY HERE\nown line without a key", "en", "b"), (31, None, "en", "c")]
    docs = frame(spark, rows).select("*", F.lit(1).alias("keep"), F.lit(2).alias("n_lines"), F.lit(3).alias("text_hash"), F.lit(4).alias("pos"))
    assert got(line_digests(docs)) == by_hand([r[:2] for r in rows])
    kept = without_repeated_lines(docs)
    assert kept.schema["doc"].dataType.names == docs.columns and {r.kept for r in kept.where("doc.doc_id = 31").collect()} == {None}
    assert line_digests(frame(spark, [])).count() == 0


def test_one_shuffle_of_the_lines_and_no_python(spark):
    docs = spark.createDataFrame(invented(), "doc_id long, text string")
    done = plan(line_digests(docs))
    assert "Python" not in done and "Arrow" not in done
    # The window over a hash's lines reads them in the ranges that they were dealt by.
    window = done[done.index("Window ["):]
    assert window.index("rangepartitioning(h1") < window.index("Scan parquet")
    assert "hashpartitioning" not in window[:window.index("rangepartitioning(h1")]
