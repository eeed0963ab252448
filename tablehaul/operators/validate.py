"""Dry run: would these rows fit the target? And the conversion that a load can be asked for."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, CharType, DataType, MapType, StringType, StructField, StructType, VarcharType

from tablehaul.operators.schema import as_schema, ddl_of, declared_type, sql_type
from tablehaul.workspace import shared_dir, unique

_REFUSED = "Error occurred during query planning"


def _mapped(df: DataFrame, target: StructType, by: str) -> dict[str, str | None]:
    """For each target column the data's column that a load would store there."""
    if by == "position":
        return {f.name: df.columns[i] if i < len(df.columns) else None for i, f in enumerate(target.fields)}
    have = {name.lower(): name for name in df.columns}
    return {f.name: have.get(f.name.lower()) for f in target.fields}


def converted(df: DataFrame, target: StructType | str, by: str = "name") -> DataFrame:
    """Cast the columns a load would use to the target's types; a value that does not fit fails the query."""
    target = as_schema(target)
    types = {name: f.dataType for f in target.fields if (name := _mapped(df, target, by)[f.name]) is not None}
    return df.select([F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def _refused_by_spark(df: DataFrame, target: StructType, mapped: dict[str, str | None], convert: bool) -> set[str]:
    """The target columns that Spark refuses to fill from the data whatever the rows hold.

    Spark itself is asked: it plans an insert into an empty table with the target's columns, or the cast. Nothing is run or written.
    """
    spark, used = df.sparkSession, {f.name: mapped[f.name] for f in target.fields if mapped[f.name] is not None}
    kinds = {f.name: f for f in target.fields}
    if convert:
        return {name for name, source in used.items() if not _plans(lambda c=source, k=kinds[name].dataType: df.select(F.col(f"`{c}`").cast(_stored(k))))}
    view, stage = unique("rows"), unique("dry_run")
    df.createOrReplaceTempView(view)
    spark.sql(f"CREATE TABLE `{stage}` ({ddl_of(target)}) USING parquet LOCATION '{shared_dir(spark)}/{stage}'")
    try:
        def fits(names: set[str]) -> bool:
            values = [f"`{used[f.name]}`" if f.name in names else f"CAST(NULL AS {sql_type(_stored(f.dataType))})" for f in target.fields]
            return not spark.sql(f"EXPLAIN INSERT INTO `{stage}` SELECT {', '.join(values)} FROM `{view}`").first()[0].startswith(_REFUSED)

        unlike = {name for name, source in used.items() if df.schema[source].dataType != kinds[name].dataType}
        return set() if fits(unlike) else {name for name in unlike if not fits({name})}
    finally:
        spark.sql(f"DROP TABLE `{stage}`")
        spark.catalog.dropTempView(view)


def _plans(make) -> bool:
    try:
        make()
    except AnalysisException:
        return False
    return True


def _stored(kind: DataType) -> DataType:
    """A type as values of it are held: texts without a length."""
    if isinstance(kind, (VarcharType, CharType)):
        return StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_stored(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(_stored(kind.keyType), _stored(kind.valueType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _stored(f.dataType)) for f in kind.fields])
    return kind


def _does_not_fit(value: Column, kind: DataType, target: DataType) -> Column:
    """Whether a value, or any value inside it, is lost or refused when it becomes one of the target's type; never null."""
    if isinstance(kind, ArrayType) and isinstance(target, ArrayType):
        return F.coalesce(F.exists(value, lambda e: _does_not_fit(e, kind.elementType, target.elementType)), F.lit(False))
    if isinstance(kind, MapType) and isinstance(target, MapType):
        return (_does_not_fit(F.map_keys(value), ArrayType(kind.keyType), ArrayType(target.keyType))
                | _does_not_fit(F.map_values(value), ArrayType(kind.valueType), ArrayType(target.valueType)))
    if isinstance(kind, StructType) and isinstance(target, StructType):
        return reduce(Column.__or__, [_does_not_fit(value.getField(a.name), a.dataType, b.dataType)
                                      for a, b in zip(kind.fields, target.fields, strict=False)], F.lit(False))
    bad = value.isNotNull() & value.try_cast(_stored(target)).isNull()
    if isinstance(target, (VarcharType, CharType)):
        # Trailing blanks beyond the length are cut when stored.
        bad = bad | (F.coalesce(F.length(F.rtrim(value.cast("string"))), F.lit(0)) > target.length)
    return bad


def _misfit(df: DataFrame, source: str | None, field: StructField, refused: set[str]) -> Column:
    if source is None:
        return F.lit(False)
    value = F.col(f"`{source}`")
    return value.isNotNull() if field.name in refused else _does_not_fit(value, df.schema[source].dataType, field.dataType)


def _lengths_kept(target: StructType | str) -> StructType:
    """The target with the text lengths that a table's schema holds beside the types."""
    fields = as_schema(target).fields
    return StructType([StructField(f.name, DataType.fromDDL(declared_type(f)) if "varchar(" in declared_type(f) else f.dataType) for f in fields])


def refused_columns(df: DataFrame, target: StructType | str, by: str = "name", convert: bool = False) -> list[str]:
    """What makes a load fail whatever the rows hold: types that Spark does not store without a cast, or not even cast; columns the
    target lacks; and by position a wrong number of columns."""
    target = _lengths_kept(target)
    mapped = _mapped(df, target, by)
    refused = _refused_by_spark(df, target, mapped, convert)
    out = [f"{f.name}: {df.schema[mapped[f.name]].dataType.simpleString()} is not stored as {declared_type(f)}" for f in target.fields if f.name in refused]
    if by == "position":
        return out + ([f"{len(df.columns)} columns for {len(target.fields)}"] if len(df.columns) != len(target.fields) else [])
    used = {m for m in mapped.values() if m is not None}
    return out + [f"{c}: not in the target" for c in df.columns if c not in used]


def validate_extract(df: DataFrame, target: StructType | str, *, by: str = "name", convert: bool = True) -> tuple[DataFrame, DataFrame]:
    """Read every value and write nothing: a one-row summary and the failing rows with their failing columns.

    Columns meet as in the load, by name or by position, and values are judged as the load stores them, those inside arrays, maps and
    structs as well: with ``convert`` by a cast, else by Spark's rules for stored values, which refuse text for a number outright. The summary
    counts all rows, failing rows, and failing values per target column, in one pass; ``refused_columns`` tells what fails without any row.
    """
    target = _lengths_kept(target)
    mapped = _mapped(df, target, by)
    refused = _refused_by_spark(df, target, mapped, convert)
    flags = {f.name: _misfit(df, mapped[f.name], f, refused) for f in target.fields}
    any_bad = reduce(Column.__or__, flags.values(), F.lit(False))
    summary = df.agg(F.count(F.lit(1)).alias("rows_total"), F.count_if(any_bad).alias("rows_failing"),
                     *[F.count_if(flag).alias(f"failing_{name}") for name, flag in flags.items()])
    names = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]))
    return summary, df.where(any_bad).withColumn("failing_columns", names)
