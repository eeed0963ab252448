"""Lines repeated across documents, kept in the first document only; in DataFrame functions alone.

Lines become 128-bit hashes, stored beside their document and position. These are dealt to tasks by ranges of the hash and sorted there by
document and position, so that one window runs over them and sees each hash's first document first. What
comes out are not texts but a bitmap per document of the lines to keep, compressed to the 64-line words in which a line
goes; it is applied where the texts are.

A hash with a thousandth of all lines or more is not dealt to a task: its first document is found by an aggregate, and sent to
the tasks that read its lines. There are about a thousand such hashes at most, whatever the number of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.common import lower_ascii, saved, text_hash

#: The fixed white space of the contract, blank and U+0009 to U+000D.
_SPACE = " \t\n\x0b\f\r"
#: A hash is common with one of so many lines; it is looked for in one of so many lines.
COMMON, LOOKED_AT = 1000, 64


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """What two lines have to agree in: white space at both ends cut off, A to Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(_SPACE)))


def _hashed(docs: DataFrame, least_chars: int, key: str, text: str) -> DataFrame:
    """``h1, h2, last, id, text_hash, pos`` of every line that is long enough; ``last`` puts null keys after all others."""
    lines = docs.select(F.col(key).alias("id"), text_hash(text), F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    keyed = lines.select("id", "text_hash", "pos", line_key(F.col("line")).alias("line")).where(F.char_length("line") >= least_chars)
    return keyed.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                        F.col("id").isNull().alias("last"), "id", "text_hash", "pos")


def _dropped(lines: DataFrame) -> DataFrame:
    """The lines that an earlier document holds, too, as ``id, text_hash, pos``."""
    place = F.struct("last", "id")
    looked_at = lines.where(F.pmod(F.xxhash64("id", "text_hash", "pos"), F.lit(LOOKED_AT)) == 0)
    common = saved(looked_at.groupBy("h1", "h2").count().where(F.col("count") * (LOOKED_AT * COMMON) >= lines.count()).select("h1", "h2"),
                   "common_lines")
    firsts = lines.join(F.broadcast(common), ["h1", "h2"]).groupBy("h1", "h2").agg(F.min(place).alias("first"))
    frequent = lines.join(F.broadcast(firsts), ["h1", "h2"])
    in_order = Window.partitionBy("h1", "h2").orderBy("last", "id", "pos")
    others = lines.join(F.broadcast(common), ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    others = others.withColumn("first", F.first(place).over(in_order))
    return frequent.unionByName(others).where(~place.eqNullSafe(F.col("first"))).select("id", "text_hash", "pos")


def keep_bitmaps(docs: DataFrame, least_chars: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text_hash, keep, n_dropped`` of every document that loses lines.

    Lines with a key (``line_key``) of at least ``least_chars`` code points that is found in several documents go, but for all
    those of the smallest document that holds it. ``keep`` is sorted by word: its bits say which of the lines 64 * word
    to 64 * word + 63 stay; of words that are not there, all do.

    Rows of one key are one document; the null key is one, too, and comes last. Rows that repeat have one bitmap. Null and
    empty texts hold no such line. Other columns are not read; an empty table gives no rows.
    """
    lines = saved(_hashed(docs, least_chars, key, text), "lines")
    bit = F.expr("shiftleft(1L, pos & 63)")
    words = _dropped(lines).groupBy("id", "text_hash", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(bit).alias("gone"))
    return words.groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"))


def _kept(text: Column, keep: Column) -> Column:
    """The lines that stay. The words are unpacked once, so that every line finds its own by its number."""
    def opened(words: Column) -> Column:
        missing = lambda w, i: w["word"] - F.coalesce(F.get(words, i - 1)["word"], F.lit(-1)) - 1
        return F.flatten(F.transform(words, lambda w, i: F.concat(F.array_repeat(F.lit(-1).cast("long"), missing(w, i)), F.array(w["bits"]))))

    def stays(bits: Column):
        return lambda line, i: F.getbit(F.coalesce(F.get(bits, F.shiftright(i, 6)), F.lit(-1).cast("long")), i.bitwiseAND(F.lit(63))) == 1

    parts = F.transform(F.array(F.struct(opened(keep).alias("bits"), _lines(text).alias("lines"))),
                        lambda s: F.array_join(F.filter(s["lines"], stays(s["bits"])), "\n"))
    return F.when(keep.isNull(), text.cast("string")).otherwise(parts[0])


def without_repeated_lines(docs: DataFrame, least_chars: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` (a struct of the row's own columns, unchanged), ``kept`` (the text without lines that go, null where it is
    null), ``n_lines`` and ``n_dropped`` (long) of every row; see ``keep_bitmaps``.

    A text of any length is cut as a whole. Repeated rows lose the same lines each; an empty table gives no rows.
    """
    maps = keep_bitmaps(docs, least_chars, key, text)
    rows = docs.select(F.struct("*").alias("doc"), F.col(key).alias("key"), text_hash(text).alias("of_text"))
    met = rows.join(maps, rows["key"].eqNullSafe(maps["id"]) & (rows["of_text"] == maps["text_hash"]), "left")
    own = F.col("doc").getField(text)
    return met.select("doc", _kept(own, F.col("keep")).alias("kept"), F.size(_lines(own)).cast("long").alias("n_lines"),
                      F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"))


def line_digests(docs: DataFrame, least_chars: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_lines, n_dropped, kept_sha256`` of every row; a null text is one empty line. See ``without_repeated_lines``."""
    kept = without_repeated_lines(docs, least_chars, key, text)
    return kept.select(F.col("doc").getField(key).alias(key), "n_lines", "n_dropped",
                       F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: The same in SQL for DuckDB.
SQL = r"""
WITH whole AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM whole),
keyed AS (SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM numbered),
judged AS (SELECT doc_id, line, pos, length(k) >= 10 AND doc_id <> min(doc_id) OVER (PARTITION BY k) AS goes FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
