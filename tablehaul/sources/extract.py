"""SQL extracts over catalog tables and views, and the few values that come to the driver."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.errors import LoadError
from tablehaul.functions.text import parse_flag


def substitute(text: str, params: Mapping[str, object]) -> str:
    """Fill ``${name}`` from ``params``; unknown names stay. For names and text that cannot be an SQL parameter."""
    return re.sub(r"\$\{([^}]+)\}", lambda m: str(params.get(m.group(1), m.group(0))), text)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows of the table named by a parameter."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def _parameter(value: object) -> object:
    if isinstance(value, dt.datetime):
        return F.expr(f"TIMESTAMP_NTZ '{value.replace(tzinfo=None).isoformat(sep=' ')}'")
    return value


def extract(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """Rows of a select; ``:name`` parameters are typed values, null included. A datetime is taken as zoneless."""
    rows = spark.sql(sql, args={name: _parameter(value) for name, value in (params or {}).items()})
    if not rows.columns:
        raise LoadError("The extract is not a select: it returns no columns")
    return rows


def run_context(spark: SparkSession, statements: Sequence[str]) -> None:
    """Statements run before the extract in the same session, such as session variables."""
    for statement in statements:
        spark.sql(statement)


def staged_extract(spark: SparkSession, steps: Sequence[tuple[str, str]], final_sql: str,
                   params: Mapping[str, object] | None = None) -> DataFrame:
    """An extract built from named steps, each a view the later ones can use.

    Views are lazy and never touch the source, so there is nothing to roll back and the optimizer sees one plan.
    """
    for name, sql in steps:
        extract(spark, sql, params).createOrReplaceTempView(name)
    return extract(spark, final_sql, params)


def _first_column(df: DataFrame) -> DataFrame:
    """The first column as ``value``, whatever the columns are called."""
    return df.toDF("value", *[f"_{i}" for i in range(1, len(df.columns))]).select("value")


def scalar(df: DataFrame) -> object | None:
    """First column of the first row; null when there is no row."""
    row = _first_column(df).first()
    return None if row is None else row[0]


def scalar_timestamp(df: DataFrame) -> dt.datetime | None:
    """As ``scalar``, as a zoneless timestamp."""
    return scalar(_first_column(df).select(F.col("value").cast("timestamp_ntz")))


def gate(df: DataFrame) -> bool:
    """Whether a load may go on: the first column of the first row is true. Null or no row means no."""
    return bool(scalar(_first_column(df).select(parse_flag(F.col("value")))))
