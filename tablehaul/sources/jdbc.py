"""Reading from a database over JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.errors import LoadError

# Driver classes of the databases that can be named by type, and the options a MySQL connection gets
# when none are given.
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "h2": "org.h2.Driver",
}
MYSQL_DEFAULTS = ("autoReconnect=true&sessionVariables=default_storage_engine%3DInnoDB&useUnicode=true"
                  "&characterEncoding=UTF-8")
# The MySQL driver streams rows only at this fetch size.
MYSQL_STREAMING = -2147483648


@dataclass(frozen=True)
class Ranges:
    """Split a read into ``parts`` ranges of a number, date or timestamp column.

    Without bounds the column's smallest and largest values are asked from the database first. Uneven values are better split by
    ``EvenSplits``.
    """

    column: str
    parts: int
    lower: object | None = None
    upper: object | None = None


@dataclass(frozen=True)
class EvenSplits:
    """Split a read into ``parts`` of about equal numbers of rows, by quantiles of a column.

    They are found in a sample: ``sample`` is a query for some of the column's values, such as every thousandth key; without one
    all of them are read once.
    """

    column: str
    parts: int
    sample: str | None = None


def _url(database_type: str, host: str | None, port: int | None, database: str | None, options: str | None) -> str:
    kind = (database_type or "").lower()
    if kind == "mysql":
        return f"jdbc:mysql://{host}:{port}/{database}?{options or MYSQL_DEFAULTS}"
    tail = f";{options}" if options else ""
    if kind == "sqlserver":
        return f"jdbc:sqlserver://{host}:{port};database={database}{tail}"
    if kind == "h2":
        return f"jdbc:h2:{database}{tail}"
    raise LoadError("A database type must be mysql, sqlserver or h2 unless a url is given")


def jdbc_options(database_type: str | None = None, host: str | None = None, port: int | None = None,
                 database: str | None = None, user: str | None = None, password: str | None = None,
                 options: str | None = None, url: str | None = None, driver: str | None = None) -> dict[str, str]:
    """Connection options for Spark's JDBC source; a given ``url`` wins over the parts."""
    url = url if url and url.strip() else _url(database_type, host, port, database, options)
    driver = driver or DRIVERS.get((database_type or "").lower())
    found = {"url": url, "user": user, "password": password, "driver": driver, "preferTimestampNTZ": "true"}
    return {name: value for name, value in found.items() if value is not None}


def even_bounds(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[object]:
    """Up to ``parts`` - 1 values that cut a column into parts of about equal numbers of rows, however uneven its values are.

    They come from a sketch of quantiles, whose size depends on ``accuracy`` alone. A value that more than a part's rows have is a
    bound once, and its rows stay together.
    """
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = keys.agg(F.approx_percentile(column, shares, accuracy)).first()[0] or []
    return sorted(set(found))


def split_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Conditions that together cover every row once: values below the first bound and nulls, between two bounds, and from the last."""
    if not bounds:
        return ["1 = 1"]

    def text(value: object) -> str:
        return str(value) if isinstance(value, (int, float, Decimal)) else f"'{value}'"

    inner = [f"{column} >= {text(a)} AND {column} < {text(b)}" for a, b in zip(bounds, bounds[1:], strict=False)]
    return [f"{column} < {text(bounds[0])} OR {column} IS NULL", *inner, f"{column} >= {text(bounds[-1])}"]


def _subquery(query: str) -> str:
    return f"({query.strip().rstrip(';')}) extract_rows"


def read_jdbc(spark: SparkSession, source: dict[str, str], query: str, *, context: str | None = None,
              fetch_size: int | None = None, ranges: Ranges | EvenSplits | None = None,
              predicates: Sequence[str] | None = None, single: bool = False) -> DataFrame:
    """Rows of a query on a database.

    ``context`` runs first in each connection. A read is split by ``ranges``, or by ``predicates``: conditions that
    together cover every row once, for a column whose values are too uneven for equal ranges. One connection, and so one
    task, reads everything only where ``single`` says so.
    """
    if (ranges is not None) + (predicates is not None) + single != 1:
        raise LoadError("Split a read by ranges or by predicates, or say that a single connection will do")
    options = dict(source)
    if context:
        options["sessionInitStatement"] = context
    if fetch_size is None and options["url"].startswith("jdbc:mysql:"):
        fetch_size = MYSQL_STREAMING
    if fetch_size is not None:
        options["fetchsize"] = str(fetch_size)
    reader = spark.read.format("jdbc").options(**options)
    if isinstance(ranges, EvenSplits):
        keys = reader.option("dbtable", _subquery(ranges.sample or f"select {ranges.column} from {_subquery(query)}")).load()
        predicates, ranges = split_predicates(ranges.column, even_bounds(keys, keys.columns[0], ranges.parts)), None
    if predicates is not None:
        properties = {name: value for name, value in options.items() if name != "url"}
        return spark.read.jdbc(options["url"], _subquery(query), predicates=list(predicates), properties=properties)
    if ranges is None:
        return reader.option("dbtable", _subquery(query)).load()
    lower, upper = ranges.lower, ranges.upper
    if lower is None or upper is None:
        bounds = f"select min({ranges.column}) as low, max({ranges.column}) as high from {_subquery(query)}"
        lower, upper = reader.option("dbtable", f"({bounds}) bounds").load().first()
        if lower is None:
            return reader.option("dbtable", _subquery(query)).load()
    return (reader.option("dbtable", _subquery(query)).option("partitionColumn", ranges.column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", str(ranges.parts)).load())
