"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import math
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablehaul.workspace import materialize, remove_dir

#: A word is a run of characters other than ASCII white space; ``bytes.split()`` yields exactly these.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this library, once per application, so that their Python workers need no path of their own."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tablehaul-"), "tablehaul"), "zip", root,
                                      "tablehaul")
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this library at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def in_slices(batches, rows: int = 256):
    """The rows of Arrow batches as tuples, few of them in Python's memory at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, rows).columns), strict=True)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back, so that lost executors repeat only what is behind it."""
    return materialize(df, label)


def discard(*frames: DataFrame) -> None:
    """Remove the files of frames that were ``saved`` and are not read any more, and of those that they are unions of."""
    for folder in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        remove_dir(frames[0].sparkSession, folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words of a whole text as a long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, nothing else; ``lower`` does that, and faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def text_hash(text: str = "text") -> Column:
    """Tells rows apart that share a key; null and empty texts have hashes of their own."""
    return F.xxhash64(F.col(text).cast("string")).alias("text_hash")


def rows_of(docs: DataFrame, chosen: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose key and text hash are among the columns ``key`` and text_hash of ``chosen``."""
    wanted = chosen.select(F.col(key).alias("_key"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(wanted, docs[key].eqNullSafe(wanted["_key"]) & (F.xxhash64(docs[text].cast("string")) == wanted["_hash"]),
                     "left_semi")


def blocks_for(rows: int, rows_per_block: int) -> int:
    return max(1, math.ceil(rows / rows_per_block))


def least_hashed(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of a stored frame, chosen by the least hashes of ``keys``.

    Rows whose hash is too large to be among them are dropped where they lie, so about ``most`` rows are sorted in all, not
    as many from every task.
    """
    order = F.pmod(F.xxhash64(*keys), F.lit(1 << 30))
    share = min(1.0, (1.2 * most + 100) / max(1, df.count()))
    return df.filter(order < int(share * (1 << 30))).orderBy(order, *keys).limit(most) if share < 1 else df.orderBy(order, *keys).limit(most)


def told_apart(df: DataFrame, out: str, chunk: int = 4096) -> DataFrame:
    """The rows with a column ``out`` (long) that numbers those which agree in all columns from 0, so that none repeat.

    They are counted before they are shuffled and made again by as many tasks as their number asks for.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))

    def up_to(n: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), n)

    few = counted.filter(F.col("_n") <= chunk).withColumn(out, F.explode(up_to(F.col("_n") - 1)))
    many = counted.filter(F.col("_n") > chunk).withColumn("_far", F.explode(up_to(F.floor((F.col("_n") - 1) / chunk))))
    many = many.repartition(F.xxhash64("_far", *df.columns)).withColumn("_near", F.explode(up_to(F.least(F.lit(chunk), F.col("_n") - F.col("_far") * chunk) - 1)))
    return few.drop("_n").unionByName(many.withColumn(out, F.col("_near") + F.col("_far") * chunk).drop("_n", "_far", "_near"))


def numbered(df: DataFrame, keys: list[str], order: list[str], rows: int, out: str,
             rows_per_block: int = 50_000, counted: DataFrame | None = None) -> DataFrame:
    """Number the rows of every key without gaps from 0, in column ``out`` (long).

    The rows of a key are dealt by a hash of ``order`` into blocks of about ``rows_per_block`` rows; the number is the
    row's place in its block plus the rows of the key's earlier blocks. No task sees a whole key, however many rows
    the key has, if ``order`` tells all rows apart (``told_apart``). ``keys`` hold no nulls. ``counted`` may give a cheaper
    frame with the same keys and order columns to count the blocks from.
    """
    block = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(blocks_for(rows, rows_per_block))).alias("_block")
    counts = (counted if counted is not None else df).groupBy(*keys, block).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_block").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    ranked = df.select("*", block).withColumn("_row", F.row_number().over(inside))
    return (ranked.join(starts, [*keys, "_block"])
            .withColumn(out, (F.col("_start") + F.col("_row") - 1).cast("long")).drop("_block", "_row", "_start"))
