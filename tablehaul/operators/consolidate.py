"""One extract over many sources, gathered in one table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul.errors import LoadError
from tablehaul.operators.shape import with_tags
from tablehaul.operators.sinks import replace_partitions, replace_table

Template = Callable[[Mapping[str, object]], DataFrame]


def consolidate(template: Template, param_sets: Sequence[Mapping[str, object]], tags: Sequence[str] = ()) -> DataFrame:
    """Rows of the template for every parameter set, as one plan whose branches run in parallel.

    ``tags`` names parameters that become constant columns. Columns must agree by name between the sources.
    """
    if not param_sets:
        raise LoadError("At least one set of parameters is required")
    slices = [with_tags(template(params), {tag: params[tag] for tag in tags}) for params in param_sets]
    return reduce(DataFrame.unionByName, slices)


def consolidate_partitions(spark: SparkSession, template: Template, param_sets: Sequence[Mapping[str, object]],
                           table: str, column: str, *, tags: Sequence[str] = (),
                           schema: StructType | str | None = None) -> DataFrame:
    """Consolidate into one partition per parameter set, replacing only those; returns the audit rows.

    Every task reads one source and so writes one partition: the rows are not shuffled.
    """
    values = [params[column] for params in param_sets]
    if len(set(values)) != len(values):
        raise LoadError(f"Two parameter sets share a value of {column}")
    rows = consolidate(template, param_sets, [*tags, column])
    return replace_partitions(spark, rows, table, column, values, schema=schema, rebalance=False)


def fan_out(tables: Sequence[str], sources: Sequence[Mapping[str, object]],
            reader: Callable[[str, Mapping[str, object]], DataFrame], tags: Sequence[str] = ()) -> dict[str, DataFrame]:
    """For each table, its rows from every source, with the first source's column order."""
    return {table: consolidate(lambda source, table=table: reader(table, source), sources, tags) for table in tables}


def load_tables(spark: SparkSession, tables: Mapping[str, DataFrame], database: str, *, at_once: int = 1) -> DataFrame:
    """Replace one table of ``database`` for each entry, with the entry's own columns; returns the audit rows.

    One after the other, a failure stops the rest. With ``at_once`` above one, so many loads share the cluster, all are
    tried, and the failures are reported together at the end.
    """
    def load(name: str) -> DataFrame:
        return replace_table(spark, tables[name], f"{database}.{name}", tables[name].schema)

    if not tables:
        raise LoadError("At least one table is required")
    if at_once == 1:
        return reduce(DataFrame.unionByName, [load(name) for name in tables])
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(load, name) for name in tables}
    failed = {name: job.exception() for name, job in running.items() if job.exception() is not None}
    if failed:
        raise LoadError(f"{len(failed)} of {len(tables)} tables failed: {', '.join(failed)}") from next(
            iter(failed.values()))
    return reduce(DataFrame.unionByName, [job.result() for job in running.values()])


def slice_counts(df: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Rows per combination of tags."""
    return df.groupBy(*tags).agg(F.count(F.lit(1)).alias("n"))
