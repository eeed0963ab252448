"""Shaping rows: extra columns, lookups, flattening."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.errors import LoadError
from tablehaul.workspace import materialize


def with_extra_columns(df: DataFrame, columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Append ``(name, type, expression)`` columns at the end; an expression may use any column of ``df``."""
    taken = {name.lower() for name in df.columns}
    for name, _, _ in columns:
        if name.lower() in taken:
            raise LoadError(f"Extra column {name} is already a column of the extract")
    return df.select("*", *[F.expr(value).cast(kind).alias(name) for name, kind, value in columns])


def with_tags(df: DataFrame, tags: dict[str, object]) -> DataFrame:
    """Add constant columns, such as the source a row came from."""
    return df.select("*", *[F.lit(value).alias(name) for name, value in tags.items()])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    A rank compared with a constant lets Spark keep one row per key before the shuffle, so a very frequent key sends
    no more than one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def lookup_priority(facts: DataFrame, dim: DataFrame, on: Sequence[str], order_by: Sequence[Column],
                    value: Sequence[str], *, ignore_case: bool = False) -> DataFrame:
    """Add the preferred matching ``dim`` row's ``value`` columns to every fact; null without a match.

    End ``order_by`` with a unique column to make ties definite. ``ignore_case`` matches text keys in lower case; the facts
    keep theirs.
    """
    if not ignore_case:
        best = first_per_key(dim, on, order_by).select(*on, *value)
        return facts.join(best, list(on), "left")
    folded = [f"_folded_{key}" for key in on]
    best = first_per_key(dim.withColumns({f: _fold(dim, k) for f, k in zip(folded, on, strict=True)}), folded, order_by)
    keyed = facts.withColumns({f: _fold(facts, k) for f, k in zip(folded, on, strict=True)})
    return keyed.join(best.select(*folded, *value), folded, "left").drop(*folded)


def _fold(df: DataFrame, key: str) -> Column:
    """A key as case-blind databases compare it: text in lower case, anything else as it is."""
    return F.lower(F.col(key)) if df.select(key).schema[0].dataType.typeName() in ("string", "varchar", "char") else F.col(key)


def lookup_any_key(facts: DataFrame, dim: DataFrame, value: str, keys: Sequence[str], returns: str, *,
                   ignore_case: bool = False) -> DataFrame:
    """Add ``returns`` of the ``dim`` row where any of ``keys`` equals the fact's ``value``, ignoring case if asked for.

    The alternatives become rows of one equality lookup instead of an OR condition. A fact whose value means two
    different rows is an error.
    """
    as_key = (lambda c: F.lower(c.cast("string"))) if ignore_case else (lambda c: c.cast("string"))
    by_key = None
    for key in keys:
        part = dim.select(as_key(F.col(key)).alias("_key"), F.col(returns).alias("_found"))
        by_key = part if by_key is None else by_key.unionByName(part)
    once = (by_key.where(F.col("_key").isNotNull()).groupBy("_key")
            .agg(F.min("_found").alias("_low"), F.max("_found").alias("_high")))
    found = (F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low"))
             .otherwise(F.raise_error(F.concat(F.lit("More than one row for "), F.col("_key")))
                        .cast(dim.schema[returns].dataType)))
    joined = facts.join(once, as_key(facts[value]) == once["_key"], "left")
    return joined.select(*[facts[c] for c in facts.columns], found.alias(returns))


#: Levels opened in one plan; what lies deeper is written to the shared folder in between, so that plans stay small.
_LEVELS = 8
_CONTAINER = "(try_cast({v} AS map<string, variant>) IS NOT NULL OR try_cast({v} AS array<variant>) IS NOT NULL)"


def json_depth(text: Column) -> Column:
    """How deep the brackets of a JSON text are nested, those inside its strings left out; 0 for a plain value or null."""
    strings = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    brackets = F.regexp_replace(F.regexp_replace(text, strings, ""), r"[^\[\]{}]", "")

    def step(state: Column, bracket: Column) -> Column:
        now = state["now"] + F.when(bracket.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.when(F.coalesce(brackets, F.lit("")) == "", 0).otherwise(
        F.aggregate(F.split(brackets, ""), start, step, lambda state: state["most"]))


def _open_one_level(rows: DataFrame, id_col: str, text_only: bool) -> DataFrame:
    """Containers are replaced by what they hold; what turned out to be a leaf is marked and not looked into again."""
    inside = rows.sparkSession.tvf.variant_explode_outer(F.when(~F.col("_leaf"), F.col("_v")).outer()).toDF("_pos", "_key", "_value")
    nothing = F.col("_pos").isNull()
    path = (F.when(nothing, F.col("_path"))
            .when(F.col("_key").isNull(), F.concat("_path", F.lit("["), F.col("_pos"), F.lit("]")))
            .when(F.col("_path") == "", F.col("_key"))
            .otherwise(F.concat("_path", F.lit("."), F.col("_key"))))
    value = F.when(nothing, F.col("_v")).otherwise(F.col("_value"))
    # Nothing inside: a leaf, or an empty container, which has no leaves.
    empty = nothing & ~F.col("_leaf") & F.expr(_CONTAINER.format(v="_v"))
    opened = (rows.lateralJoin(inside).where(~empty)
              .select(id_col, path.alias("_path"), value.alias("_v"), (F.col("_leaf") | nothing).alias("_leaf")))
    if text_only:
        opened = opened.where(F.expr(f"_leaf OR schema_of_variant(_v) = 'STRING' OR {_CONTAINER.format(v='_v')}"))
    return opened


def flatten_json(df: DataFrame, id_col: str, json_col: str, *, text_only: bool = False,
                 skip_malformed: bool = False) -> DataFrame:
    """One row ``(id, path, value)`` per leaf of a JSON column, at any depth: ``a.b``, ``a.list[0]``.

    ``text_only`` keeps text leaves and leaves out numbers, booleans and nulls, level by level. Malformed JSON fails the query unless
    it is to be skipped. One aggregate finds the deepest nesting, and just so many levels are opened, inside the scan's tasks without
    a shuffle.
    """
    parse = "try_parse_json" if skip_malformed else "parse_json"
    good = F.expr(f"try_parse_json(`{json_col}`)").isNotNull() if skip_malformed else F.lit(True)
    levels = df.agg(F.max(F.when(good, json_depth(F.col(f"`{json_col}`"))))).first()[0] or 0
    rows = (df.select(F.col(id_col), F.lit("").alias("_path"), F.expr(f"{parse}(`{json_col}`)").alias("_v"), F.lit(False).alias("_leaf"))
            .where(F.col("_v").isNotNull()))
    leaves = []
    for level in range(1, levels + 1):
        rows = _open_one_level(rows, id_col, text_only)
        if level % _LEVELS == 0 and level < levels:
            stored = materialize(rows, "opened")
            leaves.append(stored.where("_leaf"))
            rows = stored.where("NOT _leaf")
    found = reduce(DataFrame.unionByName, leaves, rows)
    if text_only:
        found = found.where(F.expr("schema_of_variant(_v) = 'STRING'"))
    return found.select(id_col, F.col("_path").alias("path"), F.col("_v").cast("string").alias("value"))
