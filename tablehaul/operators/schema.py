"""Table structure: describe, compare, create, recreate, drop.

Types are compared as declared. A ``VARCHAR(n)`` column shows up as plain string in ``df.schema`` and keeps its length
only in the field metadata, so that metadata is read first. ``CHAR(n)`` is carried as ``VARCHAR(n)``: blank padding
would break equality with ordinary strings.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from tablehaul.errors import LoadError
from tablehaul.workspace import remove_dir, unique

DECLARED_TYPE = "__CHAR_VARCHAR_TYPE_STRING"

IF_EXISTS = ("keep", "drop", "dropIfChanged")


def as_schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def declared_type(field: StructField) -> str:
    """The type as written in the table definition, lower case, ``char(n)`` shown as ``varchar(n)``."""
    declared = field.metadata.get(DECLARED_TYPE) or field.dataType.simpleString()
    return re.sub(r"\bchar\(", "varchar(", declared.lower())


def sql_type(kind: DataType) -> str:
    """A type as SQL text, the names of nested fields quoted and in their own case."""
    if isinstance(kind, StructType):
        return f"struct<{', '.join(f'`{f.name}`: {sql_type(f.dataType)}' for f in kind.fields)}>"
    if isinstance(kind, ArrayType):
        return f"array<{sql_type(kind.elementType)}>"
    if isinstance(kind, MapType):
        return f"map<{sql_type(kind.keyType)}, {sql_type(kind.valueType)}>"
    return kind.simpleString()


def ddl_of(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {sql_type(f.dataType) if isinstance(f.dataType, (StructType, ArrayType, MapType)) else declared_type(f)}"
                     for f in schema.fields)


def quoted(table: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in table.split("."))


def literal(value: object) -> str:
    """A partition value as SQL text."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def qualified(spark: SparkSession, table: str) -> str:
    """The table's name with its database, so that no temporary view is meant."""
    plain = table.replace("`", "")
    return plain if "." in plain else f"{spark.catalog.currentDatabase()}.{plain}"


def base_location(spark: SparkSession, table: str) -> str:
    """The folder that holds every version of a table's files; no table's own folder lies above or below it."""
    database, name = qualified(spark, table).rsplit(".", 1)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__loads"


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether there is a table, not a view, of this name."""
    name = qualified(spark, table)
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW"


def schema_of(spark: SparkSession, table: str) -> StructType:
    return spark.table(table).schema


def columns_of(spark: SparkSession, table: str) -> DataFrame:
    """Position, name and declared type of every column, in table order."""
    fields = schema_of(spark, table).fields
    rows = [(i, f.name, declared_type(f)) for i, f in enumerate(fields, start=1)]
    return spark.createDataFrame(rows, "pos int, name string, type string")


def describe_query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """The columns a query would return, without running it."""
    fields = spark.sql(sql, args=params).schema.fields
    rows = [(i, f.name, declared_type(f)) for i, f in enumerate(fields, start=1)]
    return spark.createDataFrame(rows, "pos int, name string, type string")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _described(spark: SparkSession, table: str, partition: tuple[str, object] | None = None) -> dict:
    clause = f"PARTITION (`{partition[0]}` = {literal(partition[1])})" if partition else ""
    return json.loads(spark.sql(f"DESCRIBE EXTENDED {quoted(table)} {clause} AS JSON").first()[0])


def location_of(spark: SparkSession, table: str, partition: tuple[str, object] | None = None) -> str:
    return _described(spark, table, partition)["location"]


def format_of(spark: SparkSession, table: str) -> str:
    """The file format of a table."""
    return _described(spark, table).get("provider", "").lower()


def _pairs(schema: StructType) -> set[tuple[str, str]]:
    return {(f.name.lower(), declared_type(f)) for f in schema.fields}


def same_schema(old: StructType, new: StructType) -> bool:
    """Equal column count and every old column (name and type, ignoring case and order) present in the new list."""
    return len(old.fields) == len(new.fields) and _pairs(old) <= _pairs(new)


def schema_diff(spark: SparkSession, old: StructType | str, new: StructType | str) -> DataFrame:
    """One row per column that was added, removed or given another type."""

    def described(schema, type_column):
        rows = [(f.name.lower(), declared_type(f)) for f in as_schema(schema).fields]
        return spark.createDataFrame(rows, f"name string, {type_column} string")

    both = described(old, "old_type").join(described(new, "new_type"), "name", "full_outer")
    change = (F.when(F.col("old_type").isNull(), "added")
              .when(F.col("new_type").isNull(), "removed")
              .otherwise("retyped"))
    return (both.where(~F.col("old_type").eqNullSafe(F.col("new_type")))
            .select("name", "old_type", "new_type", change.alias("change")))


def columns_changed(spark: SparkSession, old: str, new: str) -> int:
    """How many columns differ between two tables."""
    return schema_diff(spark, schema_of(spark, old), schema_of(spark, new)).count()


def create_table(spark: SparkSession, table: str, schema: StructType | str,
                 partition_by: Sequence[str] = (), location: str | None = None) -> None:
    """Create an empty parquet table whose files live in a versioned folder of its own.

    The table is external to the catalog, so that swapping in a new version is a metadata change and dropping the entry
    never touches files that are still being written.
    """
    table, schema = qualified(spark, table), as_schema(schema)
    known = {f.name.lower() for f in schema.fields}
    for column in partition_by:
        if column.lower() not in known:
            raise LoadError(f"Partition column {column} is not in the schema of {table}")
    location = location or f"{base_location(spark, table)}/{unique('load')}"
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {quoted(table)} ({ddl_of(schema)}) USING parquet {parts} LOCATION '{location}'")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table if it exists, with all versions of its files."""
    if table_exists(spark, table):
        table = qualified(spark, table)
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
        remove_dir(spark, base_location(spark, table))


def ensure_table(spark: SparkSession, table: str, schema: StructType | str, *, if_exists: str = "keep",
                 partition_by: Sequence[str] = ()) -> str:
    """Make sure a table exists; returns ``created``, ``kept`` or ``recreated``.

    An existing table is left alone (``keep``), always recreated (``drop``), or recreated only when its columns differ
    (``dropIfChanged``).
    """
    wanted = {choice.lower(): choice for choice in IF_EXISTS}.get(if_exists.lower())
    if wanted is None:
        raise LoadError(f"if_exists must be one of {', '.join(IF_EXISTS)}")
    table, schema = qualified(spark, table), as_schema(schema)
    if not table_exists(spark, table):
        create_table(spark, table, schema, partition_by)
        return "created"
    if wanted == "keep" or (wanted == "dropIfChanged" and same_schema(schema_of(spark, table), schema)):
        return "kept"
    drop_table(spark, table)
    create_table(spark, table, schema, partition_by)
    return "recreated"


def create_like(spark: SparkSession, table: str, source: StructType | str, *, if_exists: str = "keep") -> str:
    """Create ``table`` with the columns of another table (by name) or of a schema."""
    schema = schema_of(spark, source) if isinstance(source, str) else source
    return ensure_table(spark, table, schema, if_exists=if_exists)


def recreate_if_changed(spark: SparkSession, table: str, wanted: str) -> bool:
    """Recreate ``table`` like ``wanted`` when any column differs; true when it was recreated."""
    if table_exists(spark, table) and columns_changed(spark, table, wanted) == 0:
        return False
    ensure_table(spark, table, schema_of(spark, wanted), if_exists="drop",
                 partition_by=partition_columns(spark, wanted))
    return True
