"""Writers: append, replace, partition replace, consolidation, whole jobs. Each query returns the loaded table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablehaul.operators.consolidate import consolidate, consolidate_partitions, fan_out, load_tables, slice_counts
from tablehaul.operators.schema import create_table
from tablehaul.operators.sinks import (append_by_name, append_by_position, replace_partition, replace_partitions,
                                       replace_table)
from tablehaul.operators.validate import validate_extract
from tablehaul.plans.jobs import DryRun, bulk_import, run_sql_steps, transfer
from workload.registry import given, query, target, views

CUSTOMER = "c_custkey bigint, c_name varchar(100), c_acctbal double, c_mktsegment varchar(20), c_nationkey int"
BY_NATION = "c_custkey bigint, c_name varchar(100), c_mktsegment varchar(20), c_nationkey int"


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey FROM customer")
def gate_true(spark, sf):
    table = target(spark)
    customer = given(spark, sf, "customer")
    bulk_import(spark, customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey"), table,
                schema=CUSTOMER, only_if=customer.agg(F.count(F.lit(1)) > 0))
    return spark.table(table)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def gate_false(spark, sf):
    table = target(spark)
    orders = given(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    bulk_import(spark, orders, table, schema=orders.schema)
    bulk_import(spark, orders.where("o_orderstatus = 'F'"), table, schema=orders.schema,
                only_if=orders.where("o_orderstatus = 'none'").agg(F.count(F.lit(1)) > 0))
    return spark.table(table)


@query("SELECT * FROM customer UNION ALL SELECT * FROM customer")
def append_twice(spark, sf):
    table = target(spark)
    customer = given(spark, sf, "customer")
    for _ in range(2):
        bulk_import(spark, customer, table, schema=customer.schema, drop_and_recreate=False)
    return spark.table(table)


@query("SELECT * FROM customer")
def replace_twice(spark, sf):
    table = target(spark)
    customer = given(spark, sf, "customer")
    for _ in range(2):
        bulk_import(spark, customer, table, schema=customer.schema)
    return spark.table(table)


@query("SELECT * FROM part")
def transfer_twice(spark, sf):
    table = target(spark)
    part = given(spark, sf, "part")
    for _ in range(2):
        transfer(spark, part.select(*reversed(part.columns)), table, schema=part.schema)
    return spark.table(table)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def append_named(spark, sf):
    table = target(spark)
    create_table(spark, table, "s_suppkey bigint, s_name string, s_acctbal double")
    append_by_name(spark, given(spark, sf, "supplier").select("s_acctbal", "s_name", "s_suppkey"), table)
    return spark.table(table)


@query("SELECT s_suppkey AS id, s_name AS title, s_acctbal AS amount FROM supplier")
def append_positional(spark, sf):
    table = target(spark)
    create_table(spark, table, "id bigint, title string, amount double")
    append_by_position(spark, given(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), table)
    return spark.table(table)


@query("""
SELECT p_partkey, p_name, current_date IS NOT NULL AS stamped, 'nightly' AS reason FROM part
""")
def load_extra_columns(spark, sf):
    table = target(spark)
    bulk_import(spark, given(spark, sf, "part").select("p_partkey", "p_name"), table,
                schema="p_partkey bigint, p_name varchar(100)",
                extra_columns=[("loaded_at", "timestamp", "current_timestamp()"),
                               ("reason", "varchar(20)", "'nightly'")])
    return spark.table(table).select("p_partkey", "p_name", F.col("loaded_at").isNotNull().alias("stamped"), "reason")


def _customers_by_nation(spark, sf):
    table = target(spark)
    rows = given(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    replace_table(spark, rows, table, BY_NATION, partition_by=["c_nationkey"])
    return table, rows


@query("""
SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer
WHERE c_nationkey <> 7 OR c_mktsegment = 'BUILDING'
""")
def replace_one_partition(spark, sf):
    table, rows = _customers_by_nation(spark, sf)
    replace_partition(spark, rows.where("c_nationkey = 7 AND c_mktsegment = 'BUILDING'"), table, "c_nationkey", 7)
    return spark.table(table)


@query("SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_nationkey <> 7")
def replace_partition_empty(spark, sf):
    table, rows = _customers_by_nation(spark, sf)
    replace_partition(spark, rows.where("c_nationkey = 7 AND c_mktsegment = 'none'"), table, "c_nationkey", 7)
    return spark.table(table)


@query("""
SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer
WHERE c_nationkey NOT IN (3, 4, 5) OR (c_nationkey = 3 AND c_acctbal > 0) OR c_nationkey = 5
""")
def replace_some_partitions(spark, sf):
    table, _ = _customers_by_nation(spark, sf)
    fresh = (given(spark, sf, "customer").where("(c_nationkey = 3 AND c_acctbal > 0) OR c_nationkey = 5")
             .select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"))
    replace_partitions(spark, fresh, table, "c_nationkey", [3, 4, 5])
    return spark.table(table)


@query("""
SELECT 'c_nationkey=' || CAST(c_nationkey AS VARCHAR) AS partition, count(*) AS rows_before, count(*) AS rows_removed,
       count(*) FILTER (c_acctbal > 0) AS rows_added, count(*) FILTER (c_acctbal > 0) AS rows_after
FROM customer GROUP BY c_nationkey
""")
def replace_partitions_audit(spark, sf):
    table, _ = _customers_by_nation(spark, sf)
    fresh = (given(spark, sf, "customer").where("c_acctbal > 0")
             .select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"))
    done = replace_partitions(spark, fresh, table, "c_nationkey", range(25))
    return done.where("rows_before > 0").select("partition", "rows_before", "rows_removed", "rows_added", "rows_after")


@query("""
SELECT c_custkey, c_name, c_mktsegment, CAST(NULL AS VARCHAR) AS provider, c_nationkey FROM customer
WHERE c_nationkey = 2
""")
def replace_partition_schema_change(spark, sf):
    table = target(spark)
    rows = given(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    bulk_import(spark, rows.where("c_nationkey = 1"), table, schema=BY_NATION, partition=("c_nationkey", 1))
    wider = "c_custkey bigint, c_name varchar(100), c_mktsegment varchar(20), provider varchar(100), c_nationkey int"
    bulk_import(spark, rows.where("c_nationkey = 2"), table, schema=wider, partition=("c_nationkey", 2))
    return spark.table(table)


def _region_extract(spark, sf):
    customer, nation = given(spark, sf, "customer"), given(spark, sf, "nation")

    def template(params):
        return (customer.join(nation.where(F.col("n_regionkey") == params["region"]),
                              customer["c_nationkey"] == nation["n_nationkey"], "left_semi")
                .select("c_custkey", "c_name"))

    return template


@query("""
SELECT c_custkey, c_name, 'site ' || CAST(n_regionkey AS VARCHAR) AS site, n_regionkey + 1 AS partition_num
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def consolidate_sources(spark, sf):
    sources = [{"region": r, "site": f"site {r}", "partition_num": r + 1} for r in range(5)]
    table = target(spark)
    rows = consolidate(_region_extract(spark, sf), sources, ["site", "partition_num"])
    bulk_import(spark, rows, table, schema="c_custkey bigint, c_name string, site varchar(50), partition_num int")
    return spark.table(table)


@query("""
SELECT c_custkey, c_name, 'site ' || CAST(n_regionkey AS VARCHAR) AS site, n_regionkey + 1 AS partition_num
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2
""")
def consolidate_into_partitions(spark, sf):
    table = target(spark)
    schema = "c_custkey bigint, c_name string, site varchar(50), partition_num int"
    sources = [{"region": r, "site": f"site {r}", "partition_num": r + 1} for r in range(5)]
    template = _region_extract(spark, sf)
    consolidate_partitions(spark, template, sources, table, "partition_num", tags=["site"], schema=schema)
    # One source has nothing to give any more; its partition becomes empty, the unlisted ones stay.
    emptied = [{**sources[1]}, {**sources[2], "region": -1}]
    consolidate_partitions(spark, template, emptied, table, "partition_num", tags=["site"], schema=schema)
    return spark.table(table)


@query("""
SELECT 'customer' AS table_name, site, count(*) AS n FROM customer, (VALUES ('a'), ('b')) s(site)
WHERE (c_custkey % 3 = 0) = (site = 'a') GROUP BY site
UNION ALL
SELECT 'supplier', site, count(*) FROM supplier, (VALUES ('a'), ('b')) s(site)
WHERE (s_suppkey % 3 = 0) = (site = 'a') GROUP BY site
""")
def fan_out_tables(spark, sf):
    def reader(table, source):
        rows = given(spark, sf, table)
        return rows.where((F.col(rows.columns[0]) % 3 == 0) == F.lit(source["site"] == "a"))

    loaded = fan_out(["customer", "supplier"], [{"site": "a"}, {"site": "b"}], reader, ["site"])
    counts = [slice_counts(rows, ["site"]).select(F.lit(name).alias("table_name"), "site", "n")
              for name, rows in loaded.items()]
    return counts[0].unionByName(counts[1])


@query("""
SELECT 'customer' AS table_name, c_custkey AS row_key, c_name AS row_name, CASE WHEN c_custkey % 3 = 0 THEN 'a' ELSE 'b' END AS site FROM customer
UNION ALL SELECT 'part', p_partkey, p_name, CASE WHEN p_partkey % 3 = 0 THEN 'a' ELSE 'b' END FROM part
UNION ALL SELECT 'supplier', s_suppkey, s_name, CASE WHEN s_suppkey % 3 = 0 THEN 'a' ELSE 'b' END FROM supplier
""")
def fan_out_load(spark, sf):
    def reader(table, source):
        rows = given(spark, sf, table)
        return rows.where((F.col(rows.columns[0]) % 3 == 0) == F.lit(source["site"] == "a"))

    database = target(spark).split(".")[0]
    loaded = fan_out(["customer", "part", "supplier"], [{"site": "a"}, {"site": "b"}], reader, ["site"])
    load_tables(spark, loaded, database, at_once=3)
    parts = [spark.table(f"{database}.{table}").select(F.lit(table).alias("table_name"), F.col(f"{p}key").alias("row_key"),
                                                        F.col(f"{p[0]}_name").alias("row_name"), "site")
             for table, p in (("customer", "c_cust"), ("part", "p_part"), ("supplier", "s_supp"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_TEXT = """
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
         o_orderpriority FROM orders"""


def _as_text(spark, sf):
    return given(spark, sf, "orders").select(
        F.concat(F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise(""),
                 F.col("o_orderkey").cast("string")).alias("o_orderkey"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        "o_orderpriority")


ORDER_TARGET = "o_orderkey bigint, o_totalprice double, o_orderpriority varchar(8)"


@query(f"""
SELECT count(*) AS rows_total,
       count(*) FILTER (try_cast(o_orderkey AS BIGINT) IS NULL OR length(o_orderpriority) > 8) AS rows_failing,
       count(*) FILTER (try_cast(o_orderkey AS BIGINT) IS NULL) AS failing_o_orderkey,
       count(*) FILTER (o_totalprice IS NOT NULL AND try_cast(o_totalprice AS DOUBLE) IS NULL) AS failing_o_totalprice,
       count(*) FILTER (length(o_orderpriority) > 8) AS failing_o_orderpriority
FROM ({_TEXT})
""")
def dry_run_audit(spark, sf):
    return validate_extract(_as_text(spark, sf), ORDER_TARGET)[0]


@query(f"""
SELECT o_orderkey, o_orderpriority,
       concat_ws(',', CASE WHEN try_cast(o_orderkey AS BIGINT) IS NULL THEN 'o_orderkey' END,
                 CASE WHEN length(o_orderpriority) > 8 THEN 'o_orderpriority' END) AS failing_columns
FROM ({_TEXT}) WHERE try_cast(o_orderkey AS BIGINT) IS NULL OR length(o_orderpriority) > 8
""")
def dry_run_failing_rows(spark, sf):
    failing = validate_extract(_as_text(spark, sf), ORDER_TARGET)[1]
    return failing.select("o_orderkey", "o_orderpriority", F.array_join("failing_columns", ",").alias("failing_columns"))


@query("""
SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_num FROM orders
WHERE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2
""")
def sql_steps_with_function(spark, sf):
    views(spark, sf, "orders")
    table = target(spark, "urgent_orders")
    run_sql_steps(spark, [
        "CREATE OR REPLACE TEMPORARY FUNCTION priority_num(p STRING) RETURNS INT RETURN CAST(substr(p, 1, 1) AS INT)",
        "CREATE TABLE ${table} (o_orderkey BIGINT, priority_num INT) USING parquet",
        """INSERT INTO ${table} SELECT o_orderkey, priority_num(o_orderpriority) FROM orders
           WHERE priority_num(o_orderpriority) <= ${least}""",
    ], {"table": table, "least": 2})
    return spark.table(table)


_TEXT_THAT_FITS = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  left(o_orderpriority, 8) AS o_orderpriority FROM orders"""


@query(f"""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderpriority FROM ({_TEXT_THAT_FITS})
""")
def load_text_converted(spark, sf):
    """Text columns loaded into typed ones, which Spark's own rules for stored values would refuse."""
    text = given(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                                             F.col("o_totalprice").cast("string").alias("o_totalprice"),
                                             F.left("o_orderpriority", F.lit(8)).alias("o_orderpriority"))
    table = target(spark)
    bulk_import(spark, text, table, schema=ORDER_TARGET, convert=True)
    return spark.table(table)


@query(f"""
SELECT count(*) AS rows_total, count(*) AS rows_failing, count(o_orderkey) AS failing_o_orderkey,
       count(o_totalprice) AS failing_o_totalprice, count(*) FILTER (length(o_orderpriority) > 8) AS failing_o_orderpriority
FROM ({_TEXT})
""")
def dry_run_positional(spark, sf):
    """The columns have other names and are stored by position; text is refused for numbers, as the load refuses it."""
    renamed = _as_text(spark, sf).toDF("aa", "bb", "cc")
    try:
        bulk_import(spark, renamed, target(spark), schema=ORDER_TARGET, test_only=True)
    except DryRun as run:
        return run.summary
    raise AssertionError("a dry run always ends in DryRun")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def incremental_schema_change(spark, sf):
    """A refresh whose extract has lost a column recreates the target and loads the partition in full."""
    table = target(spark)
    rows = given(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    changes = given(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("at"))
    options = {"changes": changes, "key": "o_orderkey", "changed_at": "at", "log_table": f"{table}_log"}
    bulk_import(spark, rows, table, schema="o_orderkey bigint, o_totalprice double, o_orderpriority string, part int",
                partition=("part", 1), incremental=options)
    bulk_import(spark, rows.drop("o_orderpriority"), table, schema="o_orderkey bigint, o_totalprice double, part int",
                partition=("part", 1), incremental=options)
    return spark.table(table).drop("part")


@query("SELECT page_id, url FROM pages")
def gate_on_catalog(spark, sf):
    """A load that runs only where the catalog knows its source; the same load of an unknown one is skipped."""
    from tablehaul.operators.schema import table_exists

    source, table = target(spark, "source"), target(spark)
    replace_table(spark, given(spark, sf, "pages").select("page_id", "url"), source, "page_id bigint, url string")
    for name in ("nowhere", source):
        known = spark.createDataFrame([(table_exists(spark, name),)], "known boolean")
        bulk_import(spark, spark.table(source), table, schema="page_id bigint, url string", only_if=known)
    return spark.table(table)


@query("""
SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey > 127 THEN 'sizes' END, CASE WHEN length(o_orderpriority) > 5 THEN 'place' END) AS failing_columns,
       0 AS refused FROM orders WHERE o_orderkey > 127 OR length(o_orderpriority) > 5
""")
def dry_run_nested(spark, sf):
    """Values inside arrays and structs that the target's types do not hold."""
    rows = given(spark, sf, "orders").select("o_orderkey", F.array(F.lit(1), F.col("o_orderkey") * 1).alias("sizes"),
                                             F.struct(F.col("o_orderpriority").alias("kind"), "o_orderkey").alias("place"))
    try:
        bulk_import(spark, rows, target(spark), schema="o_orderkey bigint, sizes array<tinyint>, place struct<kind: varchar(5), n: bigint>", test_only=True)
    except DryRun as run:
        return run.failing.select("o_orderkey", F.array_join("failing_columns", ",").alias("failing_columns"), F.lit(len(run.refused)).alias("refused"))


@query("""
SELECT count(*) AS rows_total, count(*) FILTER (o_orderpriority IS NOT NULL) AS failing_kind,
       'kind: string is not stored as int | o_orderstatus: not in the target' AS refused FROM orders
""")
def dry_run_unknown_column(spark, sf):
    """What a load would refuse outright: text for a number, and a column that the target lacks."""
    rows = given(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("kind"), "o_orderstatus")
    try:
        transfer(spark, rows, target(spark), schema="o_orderkey bigint, kind int", test_only=True)
    except DryRun as run:
        return run.summary.select("rows_total", "failing_kind", F.lit(" | ".join(run.refused)).alias("refused"))
