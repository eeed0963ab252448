"""Table structure: create, compare, recreate. The tables are loaded with the given data before they are compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablehaul.operators.schema import columns_of, create_like, ensure_table, recreate_if_changed, schema_diff, schema_of
from tablehaul.operators.sinks import append_by_name, replace_table
from workload.registry import given, query, target

PART = "p_partkey bigint, p_name varchar(100), p_brand varchar(10), p_size int, p_retailprice double"
CHANGED = "p_partkey bigint, P_NAME varchar(200), p_size int, p_retailprice double, provider varchar(100)"


def _parts(spark, sf):
    return given(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


@query("""
SELECT * FROM (VALUES ('p_name', 'varchar(100)', 'varchar(200)', 'retyped'),
                      ('p_brand', 'varchar(10)', NULL, 'removed'),
                      ('provider', NULL, 'varchar(100)', 'added')) d(name, old_type, new_type, change),
LATERAL (SELECT count(CASE d.name WHEN 'p_name' THEN p_name WHEN 'p_brand' THEN p_brand END) AS values_held FROM part)
""")
def schema_diff_of_loaded_table(spark, sf):
    """What a recreate would change, with the number of values each changed column holds now."""
    table = target(spark)
    replace_table(spark, _parts(spark, sf), table, PART)
    loaded = spark.table(table)
    held = (loaded.agg(*[F.count(c).alias(c) for c in loaded.columns])
            .unpivot([], loaded.columns, "name", "values_held"))
    return (schema_diff(spark, schema_of(spark, table), CHANGED).join(held, "name", "left")
            .fillna(0, ["values_held"]))


@query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def create_like_and_load(spark, sf):
    first, second = target(spark), target(spark, "copy")
    replace_table(spark, _parts(spark, sf), first, PART)
    create_like(spark, second, first)
    append_by_name(spark, spark.table(first), second)
    return spark.table(second)


@query("SELECT p_partkey, p_name, p_size, p_retailprice, p_brand AS provider FROM part")
def create_if_changed(spark, sf):
    table = target(spark)
    ensure_table(spark, table, PART, if_exists="dropIfChanged")
    append_by_name(spark, _parts(spark, sf), table)
    ensure_table(spark, table, CHANGED, if_exists="dropIfChanged")
    append_by_name(spark, _parts(spark, sf).withColumnRenamed("p_brand", "provider"), table)
    return spark.table(table).withColumnRenamed("P_NAME", "p_name")


@query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def create_if_not_changed(spark, sf):
    table = target(spark)
    ensure_table(spark, table, PART, if_exists="dropIfChanged")
    append_by_name(spark, _parts(spark, sf), table)
    reordered = "p_size INT, P_PARTKEY bigint, p_name varchar(100), p_brand varchar(10), p_retailprice double"
    ensure_table(spark, table, reordered, if_exists="dropIfChanged")
    return spark.table(table)


@query("""
SELECT * FROM (VALUES (1, 'p_partkey', 'bigint'), (2, 'p_name', 'varchar(200)'), (3, 'p_size', 'int'),
                      (4, 'p_retailprice', 'double'), (5, 'provider', 'varchar(100)')) c(pos, name, type),
LATERAL (SELECT count(*) AS n_rows FROM part)
""")
def recreate_like_new_structure(spark, sf):
    table, wanted = target(spark), target(spark, "wanted")
    replace_table(spark, _parts(spark, sf), table, PART)
    ensure_table(spark, wanted, CHANGED)
    recreate_if_changed(spark, table, wanted)
    append_by_name(spark, _parts(spark, sf).drop("p_brand"), table)
    return (columns_of(spark, table).withColumn("name", F.lower("name"))
            .join(spark.table(table).agg(F.count(F.lit(1)).alias("n_rows"))))
