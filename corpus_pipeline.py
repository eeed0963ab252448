"""A pipeline over documents: learned quality rules, near-duplicates, secrets, source mix, packing.

Every stage takes documents and, but for the last, returns their columns. Rows of the mix appear once for each copy taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.llm.common import saved, table
from tablehaul.llm.mixing import mixed_documents
from tablehaul.llm.packing import pack
from tablehaul.llm.quality import keep_good
from tablehaul.llm.secrets import redact
from tablehaul.llm.similar import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned rules reject go, null and empty texts among them; see ``keep_good``."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links connect (five-word shingles, similarity 0.8 or more), the one with the smallest id stays.

    Null ids come last, of repeated rows one stays; see ``keep_one``."""
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays. A null text stays null and has 0 characters; see ``redact``."""
    return redact(docs).withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to three times; see ``mixed_documents``."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, those of rows that repeat apart; see ``pack``."""
    return pack(docs)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("secret scan", secret_scan),
          ("source mix", source_mix), ("packing", packing)]
#: The stages learn, hash and tokenize; SQL cannot state them, and each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
