"""Whole loads, as a user calls them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul.errors import LoadError
from tablehaul.operators.schema import as_schema, ensure_table, schema_of, table_exists
from tablehaul.operators.shape import with_extra_columns
from tablehaul.operators.sinks import (append_by_name, append_by_position, audit, replace_partition, replace_table)
from tablehaul.operators.validate import converted, refused_columns, validate_extract
from tablehaul.sources.extract import gate, substitute
from tablehaul.sources.listing import blobs_of, conform, listing_faults, parse_pages
from tablehaul.streaming.incremental import Source, incremental_load
from tablehaul.workspace import intermediate


class DryRun(LoadError):
    """Raised by a load that was only to be tested; carries the summary, the failing rows, and what makes the load fail whatever
    the rows hold (``refused``, empty if nothing does)."""

    def __init__(self, summary: DataFrame, failing: DataFrame, refused: Sequence[str] = ()):
        super().__init__("Nothing was loaded: this was a test of the extract" + "".join(f"; {r}" for r in refused))
        self.summary, self.failing, self.refused = summary, failing, list(refused)


def _tested(rows: DataFrame, wanted: StructType, by: str, convert: bool) -> DryRun:
    return DryRun(*validate_extract(rows, wanted, by=by, convert=convert), refused_columns(rows, wanted, by, convert))


def _shaped(rows: DataFrame, extra_columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    return with_extra_columns(rows, extra_columns) if extra_columns else rows


def _extended(schema: StructType | None, extra_columns: Sequence[tuple[str, str, str]]) -> StructType | None:
    if not extra_columns:
        return schema
    if schema is None:
        raise LoadError("Extra columns can only be used when a schema is given")
    return StructType(schema.fields + StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t, _ in extra_columns)).fields)


def bulk_import(spark: SparkSession, extract: Source, table: str, *, schema: StructType | str | None = None,
                only_if: DataFrame | None = None, extra_columns: Sequence[tuple[str, str, str]] = (),
                partition: tuple[str, object] | None = None, incremental: Mapping[str, object] | None = None,
                drop_and_recreate: bool = True, test_only: bool = False, convert: bool = False) -> DataFrame:
    """Load an extract into a table and return the audit row.

    * ``only_if``: skip, successfully and with the target untouched, unless its first value is true.
    * with ``schema``: replace the table, or with ``drop_and_recreate=False`` create it if absent and append.
    * without ``schema``: append by position to a table that must exist.
    * ``partition``: replace that partition only, matching columns by name; ``incremental`` adds ``incremental_load``'s
      arguments (changes, key, changed_at, log_table, ...). The extract may then be a function of the two marks.
    * ``convert``: cast values to the target's types, text included; a value that does not fit fails the load.
    * ``test_only``: check every row against the schema, load nothing, and always end in ``DryRun``.
    """
    schema = as_schema(schema) if schema is not None else None
    if partition is not None:
        column, value = partition
        if schema is None:
            raise LoadError("A partition can only be used when a schema is given")
        if not column:
            raise LoadError("A partition needs a column")
        if value is None or value == "":
            raise LoadError("A value is required for the partition column")
    elif incremental is not None:
        raise LoadError("An incremental load needs a partition")
    if incremental is None and not isinstance(extract, DataFrame):
        raise LoadError("An extract that depends on watermarks needs an incremental load")
    schema = _extended(schema, extra_columns)
    if only_if is not None and not gate(only_if):
        return audit(spark, table, "skipped")
    if incremental is not None and not test_only:
        source = _shaped(extract, extra_columns) if isinstance(extract, DataFrame) else (
            lambda previous, new: _shaped(extract(previous, new), extra_columns))
        return incremental_load(spark, source=source, target=table, partition=partition, schema=schema, **incremental)
    rows = _shaped(extract if isinstance(extract, DataFrame) else extract(None, None), extra_columns)
    if test_only:
        wanted = schema if schema is not None else schema_of(spark, table) if table_exists(spark, table) else rows.schema
        raise _tested(rows, wanted, "name" if partition is not None else "position", convert)
    if convert and schema is not None:
        rows = converted(rows, schema, by="name" if partition is not None else "position")
    if partition is not None:
        return replace_partition(spark, rows, table, *partition, schema=schema)
    if schema is None:
        return append_by_position(spark, rows, table)
    if drop_and_recreate:
        return replace_table(spark, rows.toDF(*schema.names), table, schema)
    ensure_table(spark, table, schema)
    return append_by_position(spark, rows, table)


def transfer(spark: SparkSession, extract: DataFrame, table: str, *, schema: StructType | str | None = None,
             only_if: DataFrame | None = None, extra_columns: Sequence[tuple[str, str, str]] = (),
             drop_and_recreate: bool = True, test_only: bool = False, convert: bool = False) -> DataFrame:
    """As ``bulk_import`` without partitions, matching columns by label."""
    schema = as_schema(schema) if schema is not None else None
    schema = _extended(schema, extra_columns)
    if only_if is not None and not gate(only_if):
        return audit(spark, table, "skipped")
    rows = _shaped(extract, extra_columns)
    if test_only:
        wanted = schema if schema is not None else schema_of(spark, table) if table_exists(spark, table) else rows.schema
        raise _tested(rows, wanted, "name", convert)
    if convert and schema is not None:
        rows = converted(rows, schema)
    if schema is None:
        return append_by_name(spark, rows, table)
    if drop_and_recreate:
        return replace_table(spark, rows, table, schema)
    ensure_table(spark, table, schema)
    return append_by_name(spark, rows, table)


def load_blob_listing(spark: SparkSession, pages: DataFrame, table: str, schema: StructType | str) -> DataFrame:
    """Load fetched listing pages ``(marker_in, xml)`` into a table recreated with ``schema``.

    The columns of the schema decide which fields are read. The pages have to be one chain of markers that begins with the page
    without a marker: an announced page that is missing, a page that the chain does not reach, a chain that leads back to
    an earlier page, or two different pages with one marker stop the load before anything is written. A page given twice counts once.
    """
    schema = as_schema(schema)
    fields = [f.name.lower() for f in schema.fields]
    with intermediate(parse_pages(pages, fields).withColumn("number", F.monotonically_increasing_id()), "listing") as parsed:
        faults = listing_faults(parsed).groupBy("fault").agg(F.count(F.lit(1)).alias("n"), F.min("marker").alias("least")).collect()
        if faults:
            raise LoadError("The listing is not whole: " + "; ".join(
                f"{r['n']} {r['fault']}" + (f", such as {r['least']}" if r["least"] else "") for r in sorted(faults)))
        once = parsed.groupBy("marker_in").agg(F.min("number").alias("number")).select("number")
        return replace_table(spark, conform(blobs_of(parsed.join(once, "number", "left_semi"), fields), schema), table, schema)


def run_sql_steps(spark: SparkSession, statements: Sequence[str], params: Mapping[str, object] | None = None) -> None:
    """Run statements in order, with ``${name}`` filled from ``params``; stop at the first error and name it."""
    for number, statement in enumerate(statements, start=1):
        try:
            spark.sql(substitute(statement, params or {}))
        except Exception as error:
            raise LoadError(f"Statement {number} of {len(statements)} failed: {statement.strip()}") from error
