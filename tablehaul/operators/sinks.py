"""Writers: append, full replace, partition replace, JDBC.

Every replacing writer follows one order: write the new rows to a fresh folder, then point the catalog at it, then
remove the old files. The rows are written once, the switch is a metadata change, the new rows may be computed from
the old ones, an empty result empties its partition, and a failed write leaves the target as it was.

The fresh folder is filled through a short-lived stage table with the target's columns, so that Spark's own rules for
storing values (casts, lengths) apply.

A writer returns an audit DataFrame. Written rows are counted by the write itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul.errors import LoadError
from tablehaul.operators.schema import (as_schema, base_location, create_table, ddl_of, format_of, literal,
                                        location_of, partition_columns, qualified, quoted, same_schema, schema_of,
                                        table_exists)
from tablehaul.workspace import child_dirs, make_dir, remove_dir, setting, unique

AUDIT = ("table string, partition string, action string, rows_before long, rows_removed long, rows_added long, "
         "rows_after long")


def audit(spark: SparkSession, table: str, action: str, *, partition: str | None = None, before: int | None = None,
          removed: int | None = None, added: int | None = None, after: int | None = None) -> DataFrame:
    return spark.createDataFrame([(table, partition, action, before, removed, added, after)], AUDIT)


def row_count(spark: SparkSession, table: str) -> int:
    """Rows of a table; only file footers are read."""
    return spark.table(table).count()


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that is filled by the action that writes it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """Reorder to the target's columns by name, ignoring case; a target column the data lacks becomes null."""
    have = {name.lower(): name for name in df.columns}
    unknown = set(have) - {f.name.lower() for f in schema.fields}
    if unknown:
        raise LoadError(f"Columns not in the target: {', '.join(sorted(unknown))}")
    return df.select([F.col(f"`{have[f.name.lower()]}`").alias(f.name) if f.name.lower() in have
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


# ---------------------------------------------------------------- append

def append_by_position(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Append column *i* of the data to column *i* of the table, whatever the names."""
    table = qualified(spark, table)
    if not table_exists(spark, table):
        raise LoadError(f"Table {table} does not exist and no schema was given")
    rows, seen = counted(df)
    rows.write.insertInto(table)
    return audit(spark, table, "append", removed=0, added=seen.get["rows"])


def append_by_name(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Append by column label."""
    table = qualified(spark, table)
    if not table_exists(spark, table):
        raise LoadError(f"Table {table} does not exist and no schema was given")
    return append_by_position(spark, by_name(df, schema_of(spark, table)), table)


# ---------------------------------------------------------------- staging

def _partitions(spark: SparkSession, table: str) -> dict[str, str]:
    """The partitions of a table: the value's text and the folder name made of it."""
    names = [row[0] for row in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()]
    return {unquote(name.split("=", 1)[1]): name for name in names}


def _format_for(spark: SparkSession, table: str, anew: bool) -> str:
    """The file format to stage in: the target's own, parquet for a new one."""
    kind = "parquet" if anew else format_of(spark, table)
    if kind not in ("parquet", "orc"):
        raise LoadError(f"Only parquet and ORC tables can be replaced; {table} is {kind}")
    return kind


def _write_stage(spark: SparkSession, df: DataFrame, table: str, schema: StructType, location: str, kind: str,
                 partition_by: Sequence[str] = ()) -> dict[str, str]:
    """Fill ``location`` with ``df`` through a stage table; the files stay when the stage's entry is dropped.

    Returns the folder of every partition written, by the value's text.
    """
    stage = unique(f"{table}_stage")
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {quoted(stage)} ({ddl_of(schema)}) USING {kind} {parts} LOCATION '{location}'")
    try:
        rows = df.select(spark.table(stage).columns)
        if not partition_by:
            rows.write.insertInto(stage)
            return {}
        # A task holds few partitions here, so it can keep a file open for each instead of sorting all its rows; should
        # it meet more, Spark sorts the rest.
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "4"):
            rows.write.insertInto(stage)
        return {value: f"{location}/{name}" for value, name in _partitions(spark, stage).items()}
    except Exception:
        remove_dir(spark, location)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(stage)}")


def _other_versions(spark: SparkSession, table: str, keep: str) -> list[str]:
    """The folders of a table's files that a new version makes useless.

    Only folders made by this library, which lie in the table's ``__loads`` folder. Files of a table that was made
    elsewhere stay where they are: another table may have its own below them.
    """
    base = base_location(spark, table)
    return [f"{base}/{name}" for name in child_dirs(spark, base) if name != keep.rsplit("/", 1)[-1]]


def _own(spark: SparkSession, table: str, folder: str) -> bool:
    """Whether a folder is one of those that this library made for the table."""
    plain = [unquote(x).removeprefix("file:").replace("//", "/") for x in (folder, base_location(spark, table))]
    return plain[0].startswith(plain[1] + "/")


def _folders_of(spark: SparkSession, table: str, column: str, values: Sequence[object]) -> list[str]:
    """The folders that hold the rows of some partitions, by one job that reads file names only."""
    found = spark.table(table).where(F.col(column).isin(list(values))).select(
        F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")).distinct()
    return [row["folder"] for row in found.collect()]


def _without(schema: StructType, column: str) -> StructType:
    return StructType([f for f in schema.fields if f.name.lower() != column.lower()])


def _evenly(df: DataFrame, column: str) -> DataFrame:
    """Bring each partition's rows together in well sized files; an oversized partition is split over many tasks."""
    return df.hint("rebalance", column)


# ---------------------------------------------------------------- full replace

def replace_table(spark: SparkSession, df: DataFrame, table: str, schema: StructType | str | None = None, *,
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a whole table, creating it or changing its columns as needed."""
    table = qualified(spark, table)
    exists = table_exists(spark, table)
    if schema is None and not exists:
        raise LoadError(f"Table {table} does not exist and no schema was given")
    old = schema_of(spark, table) if exists else None
    schema = as_schema(schema) if schema is not None else old
    if exists and schema is old:
        partition_by = partition_columns(spark, table)
    in_place = (exists and not partition_by and not partition_columns(spark, table) and old.names == schema.names
                and same_schema(old, schema))
    fresh = f"{base_location(spark, table)}/{unique('load')}"
    rows = by_name(df, schema)
    if len(partition_by) == 1:
        rows = _evenly(rows, partition_by[0])
    rows, seen = counted(rows)
    _write_stage(spark, rows, table, schema, fresh, _format_for(spark, table, not in_place), partition_by)
    stale = _other_versions(spark, table, fresh)
    if in_place:
        spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION '{fresh}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
        create_table(spark, table, schema, partition_by, fresh)
        if partition_by:
            spark.sql(f"ALTER TABLE {quoted(table)} RECOVER PARTITIONS")
    for folder in stale:
        remove_dir(spark, folder)
    added = seen.get["rows"]
    return audit(spark, table, "replace", added=added, after=added)


# ---------------------------------------------------------------- partition replace

def partition_text(value: object) -> str:
    """A partition value as it stands in a folder name."""
    return str(value).lower() if isinstance(value, bool) else str(value)


def typed_values(spark: SparkSession, schema: StructType, column: str, values: Sequence[object]) -> list[object]:
    """Partition values in the column's own type, so that the text ``07`` means the number 7."""
    kind = next(f.dataType for f in schema.fields if f.name.lower() == column.lower())
    texts = spark.createDataFrame([(i, partition_text(v)) for i, v in enumerate(values)], "i int, v string")
    found = dict(texts.select("i", F.col("v").try_cast(kind)).collect())
    wrong = [v for i, v in enumerate(values) if found[i] is None]
    if wrong:
        raise LoadError(f"Not values of the partition column {column}: {wrong}")
    return [found[i] for i in range(len(values))]


def partition_exists(spark: SparkSession, table: str, column: str, value: object) -> bool:
    """Whether a partition was ever loaded, even with no rows."""
    if not table_exists(spark, table):
        return False
    found = spark.sql(f"SHOW PARTITIONS {quoted(table)} PARTITION (`{column}` = {literal(value)})")
    return not found.isEmpty()


def existing_partitions(spark: SparkSession, table: str) -> set[str]:
    """The values, as text, of all partitions of a table; for loads that touch many of them."""
    return set(_partitions(spark, table))


def _only(df: DataFrame, column: str, value: object) -> DataFrame:
    """Drop the partition column after making sure that it holds nothing but ``value``."""
    present = {name.lower(): name for name in df.columns}.get(column.lower())
    if present is None:
        return df
    message = F.concat(F.lit(f"Row outside partition {column}={value}: "), F.coalesce(F.col(present).cast("string"),
                                                                                        F.lit("null")))
    fits = F.col(present).eqNullSafe(F.lit(value))
    return df.where(F.when(fits, True).otherwise(F.raise_error(message).cast("boolean"))).drop(present)


def _checked_target(spark: SparkSession, table: str, column: str, schema: StructType | str | None,
                    ) -> tuple[StructType, bool]:
    """The columns to load and whether the target has to be created or recreated for them."""
    exists = table_exists(spark, table)
    if schema is None and not exists:
        raise LoadError("Partitions can only be loaded into an existing table or with a schema")
    wanted = as_schema(schema) if schema is not None else schema_of(spark, table)
    if column.lower() not in {f.name.lower() for f in wanted.fields}:
        raise LoadError(f"Partition column {column} is not in the schema of {table}")
    if not exists:
        return wanted, True
    if [c.lower() for c in partition_columns(spark, table)] != [column.lower()]:
        raise LoadError(f"Table {table} is not partitioned by {column}")
    return wanted, not same_schema(schema_of(spark, table), wanted)


def _switch(spark: SparkSession, table: str, schema: StructType, column: str, locations: dict[object, str],
            recreate: bool) -> None:
    """Point partitions at freshly written folders; the catalog changes only here."""
    stale: list[str] = []
    if recreate:
        base = base_location(spark, table)
        fresh = next(iter(locations.values()))[len(base) + 1:].split("/")[0]
        stale = _other_versions(spark, table, fresh)
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
        create_table(spark, table, schema, [column])
    if len(locations) > 8:
        present = set(_partitions(spark, table))
    else:
        present = {partition_text(v) for v in locations if partition_exists(spark, table, column, v)}
    old = [v for v in locations if partition_text(v) in present]
    stale += [unquote(x) for x in (_folders_of(spark, table, column, old) if old else []) if _own(spark, table, x)]
    added = [f"PARTITION (`{column}` = {literal(value)}) LOCATION '{location}'"
             for value, location in locations.items() if partition_text(value) not in present]
    if added:
        spark.sql(f"ALTER TABLE {quoted(table)} ADD {' '.join(added)}")
    # Only catalog calls, which are slow one by one.
    with ThreadPoolExecutor(8) as calls:
        list(calls.map(lambda v: spark.sql(f"ALTER TABLE {quoted(table)} PARTITION (`{column}` = {literal(v)}) "
                                           f"SET LOCATION '{locations[v]}'"), old))
        list(calls.map(lambda folder: remove_dir(spark, folder), stale))


def replace_partition(spark: SparkSession, df: DataFrame, table: str, column: str, value: object, *,
                      schema: StructType | str | None = None, keep: DataFrame | None = None) -> DataFrame:
    """Make ``df`` the whole content of one partition; an empty ``df`` empties it.

    ``keep`` holds rows to retain from the present partition (an incremental load); they are counted apart. When
    ``schema`` differs from the target's columns the whole target is recreated with it.
    """
    if value is None:
        raise LoadError("A value is required for the partition column")
    table = qualified(spark, table)
    schema, recreate = _checked_target(spark, table, column, schema)
    value = typed_values(spark, schema, column, [value])[0]
    body = _without(schema, column)
    before = 0
    if partition_exists(spark, table, column, value):
        before = spark.table(table).where(F.col(column) == F.lit(value)).count()
    rows, seen = counted(by_name(_only(df, column, value), body))
    kept = None
    if keep is not None:
        old_rows, kept = counted(by_name(_only(keep, column, value), body))
        rows = old_rows.unionByName(rows)
    fresh = f"{base_location(spark, table)}/{unique('load')}"
    _write_stage(spark, rows, table, body, fresh, _format_for(spark, table, recreate))
    _switch(spark, table, schema, column, {value: fresh}, recreate)
    added = seen.get["rows"]
    held = kept.get["rows"] if kept is not None else 0
    return audit(spark, table, "replace partition", partition=f"{column}={value}", before=before,
                 removed=before - held, added=added, after=held + added)


def replace_partitions(spark: SparkSession, df: DataFrame, table: str, column: str, values: Sequence[object], *,
                       schema: StructType | str | None = None, rebalance: bool = True) -> DataFrame:
    """Replace several partitions in one write; listed partitions without rows become empty, others stay.

    ``rebalance=False`` saves the shuffle when each input task already holds rows of a single partition, as in a union
    of sources.
    """
    if not values or any(v is None for v in values):
        raise LoadError("A value is required for the partition column")
    table = qualified(spark, table)
    schema, recreate = _checked_target(spark, table, column, schema)
    values = list(dict.fromkeys(typed_values(spark, schema, column, values)))
    exists = table_exists(spark, table)
    before = {}
    if exists:
        before = dict(spark.table(table).where(F.col(column).isin(values)).groupBy(column).count().collect())
    rows = by_name(df, schema)
    fresh = f"{base_location(spark, table)}/{unique('load')}"
    kind = _format_for(spark, table, recreate)
    folders = _write_stage(spark, _evenly(rows, column) if rebalance else rows, table, schema, fresh, kind, [column])
    strangers = set(folders) - {partition_text(v) for v in values}
    if strangers:
        remove_dir(spark, fresh)
        raise LoadError(f"Rows outside the listed partitions of {table}: {column} in {', '.join(sorted(strangers))}")
    # The partition column alone is read back, so only folder names and file footers are.
    only = StructType([f for f in schema.fields if f.name.lower() == column.lower()])
    written = dict(spark.read.schema(only).format(kind).load(fresh).groupBy(column).count().collect()) if folders else {}
    locations = {}
    for number, value in enumerate(values):
        locations[value] = folders.get(partition_text(value)) or f"{fresh}/empty_{number}"
        if partition_text(value) not in folders:
            make_dir(spark, locations[value])
    _switch(spark, table, schema, column, locations, recreate)
    out = [(table, f"{column}={v}", "replace partition", before.get(v, 0), before.get(v, 0), written.get(v, 0),
            written.get(v, 0)) for v in values]
    return spark.createDataFrame(out, AUDIT)


# ---------------------------------------------------------------- JDBC

def write_jdbc(df: DataFrame, target: dict[str, str], table: str, *, mode: str = "append", batch_size: int = 1000,
               timeout: int = 7200, truncate: bool = False, max_connections: int | None = None) -> None:
    """Write to a database table by column label; ``overwrite`` recreates it, or only empties it with ``truncate``.

    Each task commits on its own, so a task that is repeated after its commit was lost may insert its rows again; load
    a stage table with ``overwrite`` and move it in the database where that matters.
    """
    rows = df.coalesce(max_connections) if max_connections else df
    (rows.write.format("jdbc").options(**target)
     .option("dbtable", table).option("batchsize", batch_size).option("queryTimeout", timeout)
     .option("truncate", str(truncate).lower()).mode(mode).save())
