"""Incremental refresh of one partition between two high-water marks.

A change log names which keys changed and when. A refresh keeps the partition's rows whose key did not change in the
closed window [previous, new], takes the source's present rows of the changed keys, and swaps both in together. A key
that changed but is gone from the source therefore disappears from the target.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from tablehaul.errors import LoadError
from tablehaul.functions.dates import ntz, same_zone_literal
from tablehaul.operators.schema import as_schema, ensure_table, literal, qualified, same_schema, schema_of, table_exists
from tablehaul.operators.sinks import (AUDIT, append_by_name, audit, counted, existing_partitions, partition_exists, partition_text,
                                       replace_partition, replace_partitions, typed_values)
from tablehaul.sources.extract import scalar_timestamp
from tablehaul.streaming.bloom import bloom_filter, might_hold
from tablehaul.workspace import intermediate, materialize

LOG_SCHEMA = ("table_name string, partition_num string, starting_watermark timestamp_ntz, "
              "ending_watermark timestamp_ntz, completed_datetime timestamp_ntz")

INITIAL = "initial-load"
DELTA = "incremental-load"

Source = DataFrame | Callable[[dt.datetime | None, dt.datetime | None], DataFrame]


def new_watermark(changes: DataFrame, changed_at: str) -> dt.datetime | None:
    """The latest change; null for an empty log."""
    return scalar_timestamp(changes.agg(F.max(changed_at)))


def previous_watermarks(log: DataFrame) -> DataFrame:
    """The highest recorded mark of every table and partition."""
    return log.groupBy("table_name", "partition_num").agg(F.max("ending_watermark").alias("ending_watermark"))


def previous_watermark(spark: SparkSession, log_table: str, table: str, value: object) -> dt.datetime | None:
    """The highest recorded mark of one partition; null when there is no log or no entry. Other errors are raised."""
    if not table_exists(spark, log_table):
        return None
    table = qualified(spark, table)
    log = spark.table(qualified(spark, log_table)).where((F.col("table_name") == table) & (F.col("partition_num") == partition_text(value)))
    return scalar_timestamp(log.agg(F.max("ending_watermark")))


def record_watermark(spark: SparkSession, log_table: str, table: str, value: object, previous: dt.datetime | None,
                     new: dt.datetime) -> None:
    ensure_table(spark, log_table, LOG_SCHEMA)
    entry = spark.range(1, numPartitions=1).select(
        F.lit(qualified(spark, table)).alias("table_name"), F.lit(partition_text(value)).alias("partition_num"),
        ntz(previous).alias("starting_watermark"), ntz(new).alias("ending_watermark"),
        F.localtimestamp().alias("completed_datetime"))
    append_by_name(spark, entry, log_table)


def in_window(changes: DataFrame, changed_at: str, previous: dt.datetime | None, new: dt.datetime | None) -> DataFrame:
    """Changes in the closed window; a missing end matches nothing."""
    if previous is None or new is None:
        return changes.limit(0)
    kind = changes.select(changed_at).schema[0].dataType.simpleString()
    return changes.where(F.col(changed_at).between(same_zone_literal(previous, kind), same_zone_literal(new, kind)))


def changed_keys(changes: DataFrame, key: Sequence[str], changed_at: str, previous: dt.datetime | None,
                 new: dt.datetime | None) -> DataFrame:
    """Each changed key once, however often it changed; repeats are removed before the shuffle."""
    return in_window(changes, changed_at, previous, new).select(*key).distinct()


def delta(source: DataFrame, changes: DataFrame, key: Sequence[str], changed_at: str, previous: dt.datetime | None,
          new: dt.datetime | None, *, dedup: bool = True) -> DataFrame:
    """The rows to load: all when there is no previous mark, else those whose key changed in the window.

    With ``dedup=False`` a key that is logged several times repeats its rows. The keys are written out first: only with
    their size known can Spark send a small set to every task instead of shuffling the source.
    """
    if previous is None:
        return source
    if dedup:
        changed = changed_keys(changes, key, changed_at, previous, new)
        return source.join(materialize(changed, "changed_keys"), list(key), "left_semi")
    window = in_window(changes, changed_at, previous, new).select(*key)
    return source.join(materialize(window, "changed_rows"), list(key))


# Key types whose order is the same in Spark and in every database, unlike that of text.
ORDERED_ALIKE = ("tinyint", "smallint", "int", "bigint")


def _key_range(changed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Observation | None]:
    """``changed`` with its smallest and largest key observed while it is written, for a single whole-number key."""
    if len(keys) != 1 or changed.schema[0].dataType.simpleString() not in ORDERED_ALIKE:
        return changed, None
    seen = Observation()
    return changed.observe(seen, F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high")), seen


def _in_range(rows: DataFrame, key: str, seen: Observation | None) -> DataFrame:
    """Leave out rows that no changed key can match, by a condition that a file scan or a database can evaluate."""
    if seen is None or rows.select(key).schema[0].dataType.simpleString() not in ORDERED_ALIKE or seen.get["low"] is None:
        return rows
    return rows.where(F.col(key).between(seen.get["low"], seen.get["high"]))


class _Narrowed:
    """The changed keys, with what leaves out or sets apart rows before they are joined with them."""

    def __init__(self, changed: DataFrame, keys: Sequence[str], ignore_case: bool, n: int, bloom_from: int):
        self.changed, self.keys, self.ignore_case = changed, list(keys), ignore_case
        bloom, self.bits = bloom_filter(changed.select(*keys), n)
        self.bloom = materialize(bloom, "bloom") if n >= bloom_from else None

    def _maybe(self, rows: DataFrame) -> Column | None:
        kinds = [rows.select(k).schema[0].dataType for k in self.keys]
        if self.bloom is None or kinds != [f.dataType for f in self.changed.select(*self.keys).schema.fields]:
            return None  # values that are equal only after a cast have hashes of their own
        texts = [self.ignore_case and kind.typeName() in ("string", "varchar", "char") for kind in kinds]
        return might_hold(self.bloom, self.bits, [F.lower(k) if text else F.col(k) for k, text in zip(self.keys, texts, strict=True)])

    def matching(self, rows: DataFrame, how: str) -> DataFrame:
        """The rows of changed keys (``left_semi``, ``inner``)."""
        maybe = self._maybe(rows)
        return _matching(rows if maybe is None else rows.where(maybe), self.changed, self.keys, how, self.ignore_case)

    def others(self, rows: DataFrame) -> DataFrame:
        """The rows of all other keys; those that certainly are some take no part in the join."""
        maybe = self._maybe(rows)
        if maybe is None:
            return _matching(rows, self.changed, self.keys, "left_anti", self.ignore_case)
        return rows.where(~maybe).unionByName(_matching(rows.where(maybe), self.changed, self.keys, "left_anti", self.ignore_case))


def _folded(df: DataFrame, keys: Sequence[str], ignore_case: bool) -> DataFrame:
    """Text keys in lower case, as a database with a case-blind collation compares them."""
    if not ignore_case:
        return df
    kinds = {f.name.lower(): f.dataType.typeName() for f in df.schema.fields}
    return df.withColumns({k: F.lower(k) for k in keys if kinds.get(k.lower()) in ("string", "varchar", "char")})


def _matching(rows: DataFrame, changed: DataFrame, keys: Sequence[str], how: str, ignore_case: bool, exact: Sequence[str] = ()) -> DataFrame:
    """Join rows with changed keys by equality; a folded key is computed once per side and the rows keep their own. The columns
    ``exact`` are compared as they are."""
    by = [*exact, *(k for k in keys if k not in exact)]
    if not ignore_case:
        return rows.join(changed, by, how)
    names = {k: k if k in exact else f"_folded_{k}" for k in by}
    folded = _folded(rows.withColumns({n: F.col(k) for k, n in names.items() if n != k}), [n for k, n in names.items() if n != k], True)
    other = changed.select([F.col(k).alias(n) for k, n in names.items()])
    return folded.join(other, list(names.values()), how).select(rows.columns)


def _marked(df: DataFrame, mark: str | None, kind: str) -> DataFrame:
    return df.withColumn(mark, F.lit(kind)) if mark else df


def incremental_load(spark: SparkSession, *, source: Source, changes: DataFrame, key: str | Sequence[str],
                     changed_at: str, target: str, partition: tuple[str, object], log_table: str,
                     schema: StructType | str | None = None, mark: str | None = None, dedup: bool = True,
                     on_schema_change: str = "recreate", ignore_case: bool = False, bloom_from: int = 100_000) -> DataFrame:
    """Bring one partition of ``target`` up to the change log's latest mark; returns the audit row.

    ``source`` is the full extract, narrowed to the changed keys here, or a function of (previous, new) marks that
    returns the rows to load, which lets a database choose them by its own query instead of sending everything.
    ``mark`` names a column that tells initial from incremental rows. ``schema`` defaults to
    the source's columns plus the partition column.

    Nothing is done when the latest mark is the recorded one. Changed columns recreate the whole target and reload
    this partition in full (``on_schema_change="fail"`` refuses instead). A partition that is not in the target is
    loaded in full whatever the log says. ``ignore_case`` matches text keys as case-blind databases do. From ``bloom_from`` changed
    keys on, a Bloom filter of them keeps most other rows of the source and the target out of the joins; the result is the same.
    """
    if on_schema_change not in ("recreate", "fail"):
        raise LoadError("on_schema_change must be recreate or fail")
    column, value = partition
    if not column or value is None:
        raise LoadError("An incremental load needs a partition column and a value")
    if not log_table:
        raise LoadError("An incremental load needs a table to record its watermarks in")
    keys = [key] if isinstance(key, str) else list(key)
    if not keys or not changed_at:
        raise LoadError("An incremental load needs the change log's key and time columns")

    target, log_table = qualified(spark, target), qualified(spark, log_table)
    new = new_watermark(changes, changed_at)
    previous = previous_watermark(spark, log_table, target, value)
    if not partition_exists(spark, target, column, value):
        previous = None

    rows = source if isinstance(source, DataFrame) else source(previous, new)
    if schema is None:
        taken = {c.lower() for c in rows.columns}
        extra = StructType.fromDDL(f"`{mark}` string") if mark and mark.lower() not in taken else StructType()
        tail = spark.range(0).select(F.lit(value).alias(column)).schema if column.lower() not in taken else StructType()
        schema = StructType(rows.schema.fields + extra.fields + tail.fields)
    schema = as_schema(schema)
    if table_exists(spark, target) and not same_schema(schema_of(spark, target), schema):
        if on_schema_change == "fail":
            raise LoadError(f"The columns of {target} differ from the extract's")
        if previous is not None:
            previous = None
            rows = source if isinstance(source, DataFrame) else source(None, new)

    label = f"{column}={value}"
    if new is not None and new == previous:
        return audit(spark, target, "skipped", partition=label)
    if previous is None:
        done = replace_partition(spark, _marked(rows, mark, INITIAL), target, column, value, schema=schema)
        kind = INITIAL
    elif new is None or new < previous:
        # An empty window changes nothing, so the partition is not rewritten.
        done = audit(spark, target, DELTA, partition=label, removed=0, added=0)
        kind = DELTA
    else:
        # Written once because both sides need it, and so that the joins know its size.
        window = _folded(in_window(changes, changed_at, previous, new).select(*keys), keys, ignore_case)
        window, seen = _key_range(window.distinct() if dedup else window, keys)
        window, number = counted(window)
        with intermediate(window, "changed_keys") as changed:
            narrowed = _Narrowed(changed, keys, ignore_case, number.get["rows"], bloom_from)
            if isinstance(source, DataFrame):
                rows = narrowed.matching(_in_range(rows, keys[0], seen), "left_semi" if dedup else "inner")
                # Few rows from many tasks: gather them in files of a good size.
                rows = rows.hint("rebalance")
            current = spark.table(target).where(F.col(column) == F.lit(value))
            kept = narrowed.others(current)
            done = replace_partition(spark, _marked(rows, mark, DELTA), target, column, value, schema=schema,
                                     keep=kept)
        kind = DELTA
    if new is not None:
        record_watermark(spark, log_table, target, value, previous, new)
    return done.withColumn("action", F.lit(kind))


def partition_predicates(marks: DataFrame, column: str, changed: str) -> list[str]:
    """One condition per partition of ``marks`` (value, previous, new), as ``read_jdbc`` takes them: the whole partition where it has
    no previous mark, else its rows that also meet ``changed``, a condition with {previous} and {new} in it."""
    return [f"{column} = {literal(m['value'])}" + ("" if m["previous"] is None else f" AND ({changed.format(previous=m['previous'], new=m['new'])})")
            for m in marks.orderBy("value").collect()]


def incremental_load_partitions(spark: SparkSession, *, source: DataFrame | Callable[[DataFrame], DataFrame], changes: DataFrame,
                                key: str | Sequence[str], changed_at: str, target: str, column: str, values: Sequence[object],
                                log_table: str, schema: StructType | str | None = None, mark: str | None = None, dedup: bool = True,
                                on_schema_change: str = "recreate", ignore_case: bool = False) -> DataFrame:
    """Bring many partitions of ``target`` up to their own latest marks in one write; one audit row per value.

    ``source`` and ``changes`` carry the partition column; each partition has its own marks. Partitions without a new mark
    are left alone, new ones are loaded in full, the others are merged as in ``incremental_load``. The marks of all
    partitions are found by one job each and recorded together once the partitions are switched.

    ``source`` may be a function of the marks to load, a frame (value, previous, new; previous is null for a full load), that returns
    the rows to load, so that a database can choose them (``partition_predicates``); ``schema`` has to be given then. The other options
    are those of ``incremental_load``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not keys or not changed_at or not column or not values or not log_table:
        raise LoadError("A load of many partitions needs keys, a time column, a partition column, values and a log table")
    if on_schema_change not in ("recreate", "fail"):
        raise LoadError("on_schema_change must be recreate or fail")
    if schema is None and not isinstance(source, DataFrame):
        raise LoadError("A source that depends on marks needs a schema")
    target, log_table = qualified(spark, target), qualified(spark, log_table)
    if schema is None:
        extra = StructType.fromDDL(f"`{mark}` string") if mark else StructType()
        schema = StructType(source.schema.fields + extra.fields)
    schema = as_schema(schema)
    values = list(dict.fromkeys(typed_values(spark, schema, column, values)))
    recreate = table_exists(spark, target) and not same_schema(schema_of(spark, target), schema)
    if recreate and on_schema_change == "fail":
        raise LoadError(f"The columns of {target} differ from the extract's")
    latest = dict(changes.where(F.col(column).isin(values)).groupBy(column).agg(F.max(changed_at).cast("timestamp_ntz")).collect())
    recorded: dict[str, dt.datetime] = {}
    if table_exists(spark, log_table) and not recreate:
        log = spark.table(log_table).where(F.col("table_name") == target)
        recorded = {r["partition_num"]: r["ending_watermark"] for r in previous_watermarks(log).collect()}
    there = existing_partitions(spark, target) if table_exists(spark, target) and not recreate else set()
    new = {v: latest.get(v) for v in values}
    previous = {v: recorded.get(partition_text(v)) if partition_text(v) in there else None for v in values}
    full = [v for v in values if previous[v] is None]
    merged = [v for v in values if previous[v] is not None and new[v] is not None and new[v] > previous[v]]
    if not full and not merged:
        rows = [(target, f"{column}={v}", "skipped", None, None, None, None) for v in values]
        return spark.createDataFrame(rows, AUDIT)
    kind, part = changes.schema[changed_at].dataType, next(f.dataType for f in schema.fields if f.name.lower() == column.lower())
    marks = spark.createDataFrame([(v, previous[v], new[v]) for v in full + merged], StructType(
        [StructField("value", part), StructField("previous", TimestampNTZType()), StructField("new", TimestampNTZType())]))
    ends = marks.where("previous IS NOT NULL").toDF("_value", "_from", "_to")
    window = changes.join(ends, changes[column] == ends["_value"]).where(
        F.col(changed_at).between(F.col("_from").cast(kind), F.col("_to").cast(kind))).select(
        F.col("_value").alias(column), *[changes[k] for k in keys if k != column])
    folding = [k for k in keys if k != column]
    window = _folded(window, folding, ignore_case)
    with intermediate(window.distinct() if dedup else window, "changed_keys") as changed:
        def matching(rows: DataFrame, how: str) -> DataFrame:
            return _matching(rows, changed, keys, how, ignore_case, exact=[column])

        if isinstance(source, DataFrame):
            rows = _marked(source.where(F.col(column).isin(full)), mark, INITIAL).unionByName(
                _marked(matching(source.where(F.col(column).isin(merged)), "left_semi" if dedup else "inner"), mark, DELTA))
        else:
            rows = source(marks)
            if mark:
                rows = rows.withColumn(mark, F.when(F.col(column).isin(full), INITIAL).otherwise(DELTA))
        if merged:
            rows = rows.unionByName(matching(spark.table(target).where(F.col(column).isin(merged)), "left_anti"), allowMissingColumns=True)
        done = replace_partitions(spark, rows, target, column, full + merged, schema=schema)
    marked = [v for v in full + merged if new[v] is not None]
    if marked:
        ensure_table(spark, log_table, LOG_SCHEMA)
        entries = spark.createDataFrame([(target, partition_text(v), previous[v], new[v]) for v in marked],
                                        "table_name string, partition_num string, starting_watermark timestamp_ntz, "
                                        "ending_watermark timestamp_ntz")
        append_by_name(spark, entries.withColumn("completed_datetime", F.localtimestamp()), log_table)
    kinds = spark.createDataFrame([(f"{column}={v}", INITIAL) for v in full] + [(f"{column}={v}", DELTA) for v in merged], "partition string, kind string")
    skipped = [(target, f"{column}={v}", "skipped", None, None, None, None) for v in values if v not in full and v not in merged]
    done = done.join(kinds, "partition").withColumn("action", F.col("kind")).select(spark.createDataFrame([], AUDIT).columns)
    return done.unionByName(spark.createDataFrame(skipped, AUDIT))
