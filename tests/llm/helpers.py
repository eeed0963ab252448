"""Odd documents that every operator has to survive, and small readings of the contracts."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, size long, shard int, label int, length int"


def frame(spark, rows):
    """Documents (doc_id, text, lang, source) with further columns whose names operators use for themselves."""
    return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t), 7, 8, 9, None, 3)
                                  for i, t, lang, source in rows], SCHEMA)


def odd_rows():
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    plain = "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today"
    return [(1, plain, "en", "a"), (2, plain, "en", "a"), (3, None, None, None), (4, "", "de", "b"), (None, "no key here", "en", "b"),
            (5, long, "en", "c"), (5, long, "en", "c"), (6, "   \t\n\u00a0 ", "fr", None), (7, "x" * 50_000, "en", "a"),
            (8, "one\ntwo\none\n\n one\ntwo", "es", "c"), (9, "Straße É çà 日本語 😀 \x1c ok", "de", "b"), (2**40, "big id", "en", "a")]
