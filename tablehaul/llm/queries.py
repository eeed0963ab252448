"""The registered query of each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.llm import hard_negatives, line_dedup
from tablehaul.llm.common import table
from tablehaul.workspace import shared_dir, unique

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.quality import judge

    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies",
                                                         "shards")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.token_files import read_digests, write_store

    docs, path = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/{unique('token_store')}"
    write_store(docs, path)
    return read_digests(spark, path, docs.select("doc_id")).withColumnRenamed("key", "doc_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.graph_search import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), 8)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.line_dedup import line_digests

    return line_digests(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablehaul.llm.hard_negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


#: The operators' queries in their order.
QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_quality_rules, op2_mixing, op3_packing, op4_toxicity,
                                                     op5_html_text, op6_token_ids, op7_simhash, op8_nearest, op9_secrets,
                                                     op10_sharding, op11_spelling_variants, op12_line_dedup, op13_hard_negatives)}
#: What SQL can state; the others are tested against a brute-force version.
SQL: dict[str, str] = {"op12_line_dedup": line_dedup.SQL, "op13_hard_negatives": hard_negatives.SQL}
