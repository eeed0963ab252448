"""Registration of queries and access to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablehaul.workspace import scratch_database

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[fn.__name__] = (fn, sql)
        return fn

    return register


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def views(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    for table in tables:
        given(spark, sf_dir, table).createOrReplaceTempView(table)


def target(spark: SparkSession, name: str = "target") -> str:
    """The name of a table that does not exist yet."""
    return f"{scratch_database(spark)}.{name}"
