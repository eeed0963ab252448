"""Extracts, filters, joins, aggregates, lookups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tablehaul.functions import clip_message, contains_text, field_rank, label, starts_with_text
from tablehaul.operators.schema import describe_query
from tablehaul.operators.shape import (flatten_json, lookup_any_key, lookup_priority, with_extra_columns, with_tags)
from tablehaul.sources import even_bounds, extract, read_table, run_context, split_predicates, staged_extract, substitute
from tablehaul.streaming import changed_keys, delta, in_window, new_watermark, previous_watermarks
from workload.registry import given, query, views

FROM, UNTIL = datetime(2024, 1, 10), datetime(2024, 1, 12)
WINDOW = "ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'"


@query("SELECT c_custkey, c_name FROM customer")
def extract_projection(spark, sf):
    views(spark, sf, "customer")
    return extract(spark, "SELECT c_custkey, c_name FROM customer")


@query("SELECT * FROM supplier")
def scan_named_table(spark, sf):
    views(spark, sf, "supplier")
    return read_table(spark, "supplier")


@query(f"""
SELECT c_custkey, c_name, 'incremental-load' AS message FROM customer
WHERE c_custkey IN (SELECT user_id FROM events WHERE {WINDOW})
""")
def staged_extract_delta(spark, sf):
    views(spark, sf, "customer", "events")
    return _staged(spark, {"previous": FROM, "new": UNTIL})


@query("SELECT c_custkey, c_name, 'initial-load' AS message FROM customer")
def staged_extract_initial(spark, sf):
    views(spark, sf, "customer", "events")
    return _staged(spark, {"previous": None, "new": UNTIL})


def _staged(spark, marks):
    return staged_extract(spark, [
        ("initial_rows", "SELECT c_custkey, c_name, 'initial-load' AS message FROM customer WHERE :previous IS NULL"),
        ("delta_rows", """SELECT c_custkey, c_name, 'incremental-load' AS message FROM customer
                          LEFT SEMI JOIN events ON c_custkey = user_id
                          AND ts >= :previous AND ts <= :new
                          WHERE :previous IS NOT NULL"""),
    ], "SELECT * FROM initial_rows UNION ALL SELECT * FROM delta_rows", marks)


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt%'")
def extract_context_param(spark, sf):
    views(spark, sf, "part")
    run_context(spark, ["DECLARE OR REPLACE VARIABLE wanted_name STRING DEFAULT 'bolt'"])
    return extract(spark, "SELECT p_partkey, p_name FROM part WHERE p_name LIKE concat('%', wanted_name, '%')")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%gear%'")
def extract_substituted(spark, sf):
    views(spark, sf, "part")
    sql = substitute("SELECT p_partkey, p_name FROM ${table} WHERE p_name LIKE '%${word}%'",
                     {"table": "part", "word": "gear"})
    return extract(spark, sql)


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def filter_prefix(spark, sf):
    return given(spark, sf, "part").where(starts_with_text(F.col("p_name"), "red")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_type FROM part WHERE lower(p_type) LIKE '%econ%'")
def filter_contains_ignoring_case(spark, sf):
    return (given(spark, sf, "part").where(contains_text(F.col("p_type"), "EcOn", ignore_case=True))
            .select("p_partkey", "p_type"))


@query(f"SELECT event_id, ts FROM events WHERE {WINDOW}")
def filter_window_closed(spark, sf):
    return in_window(given(spark, sf, "events"), "ts", FROM, UNTIL).select("event_id", "ts")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def filter_equality(spark, sf):
    views(spark, sf, "orders")
    return extract(spark, "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = :status", {"status": "F"})


@query("SELECT c_custkey, c_acctbal FROM customer")
def filter_null_switch(spark, sf):
    data = given(spark, sf, "customer").select("c_custkey", "c_acctbal")
    changes = given(spark, sf, "events").withColumnRenamed("user_id", "c_custkey")
    return delta(data, changes, ["c_custkey"], "ts", None, UNTIL)


@query("""
SELECT c_custkey, c_name, 'central' AS site, CAST(3 AS INTEGER) AS partition_num, upper(c_mktsegment) AS segment
FROM customer
""")
def extra_columns(spark, sf):
    return with_extra_columns(given(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), [
        ("site", "varchar(50)", "'central'"), ("partition_num", "int", "3"),
        ("segment", "string", "upper(c_mktsegment)")]).drop("c_mktsegment")


@query("SELECT 'north' AS site, o_orderkey AS order_id, o_orderpriority AS priority, 2 AS partition_num FROM orders")
def alias_literals(spark, sf):
    rows = given(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                             F.col("o_orderpriority").alias("priority"))
    return with_tags(rows, {"site": "north", "partition_num": 2})


@query(f"""
SELECT o_orderkey, o_custkey FROM orders
WHERE EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey AND {WINDOW})
""")
def join_changed_keys(spark, sf):
    changes = given(spark, sf, "events").withColumnRenamed("user_id", "o_custkey")
    rows = given(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return delta(rows, changes, ["o_custkey"], "ts", FROM, UNTIL)


@query(f"SELECT o_orderkey, o_custkey FROM orders JOIN events ON user_id = o_custkey AND {WINDOW}")
def join_changed_rows(spark, sf):
    changes = given(spark, sf, "events").withColumnRenamed("user_id", "o_custkey")
    rows = given(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return delta(rows, changes, ["o_custkey"], "ts", FROM, UNTIL, dedup=False)


@query("""
SELECT 'west' AS site, o_orderkey, c_name, n_name, o_orderdate
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey AND n_name = (SELECT min(n_name) FROM nation)
""")
def join_star_filtered(spark, sf):
    views(spark, sf, "orders", "customer", "nation")
    return extract(spark, """
        SELECT 'west' AS site, o_orderkey, c_name, n_name, o_orderdate
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey AND n_name = (SELECT min(n_name) FROM nation)""")


@query(f"""
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND {WINDOW})
""")
def delete_by_join(spark, sf):
    changes = given(spark, sf, "events").withColumnRenamed("user_id", "c_custkey")
    gone = changed_keys(changes, ["c_custkey"], "ts", FROM, UNTIL)
    return given(spark, sf, "customer").select("c_custkey", "c_name").join(gone, "c_custkey", "left_anti")


@query("SELECT max(ts) AS watermark FROM events")
def max_watermark(spark, sf):
    mark = new_watermark(given(spark, sf, "events"), "ts")
    return spark.createDataFrame([(mark,)], "watermark timestamp_ntz")


@query("""
SELECT o_orderstatus AS table_name, o_orderpriority AS partition_num, max(o_orderdate) AS ending_watermark
FROM orders GROUP BY ALL
""")
def previous_watermark(spark, sf):
    log = given(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("table_name"), F.col("o_orderpriority").alias("partition_num"),
        F.col("o_orderdate").alias("ending_watermark"))
    return previous_watermarks(log)


@query("SELECT count(*) AS n_rows, count(*) FILTER (l_returnflag = 'R') AS n_returned FROM lineitem")
def count_rows(spark, sf):
    return given(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))


@query("SELECT count(DISTINCT l_partkey) AS n_parts FROM lineitem WHERE l_shipdate IS NOT NULL")
def count_distinct(spark, sf):
    return (given(spark, sf, "lineitem").where(F.col("l_shipdate").isNotNull())
            .agg(F.countDistinct("l_partkey").alias("n_parts")))


@query("""
SELECT c_custkey, c_name, o_orderkey, o_orderpriority FROM customer LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
    CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 0 END DESC, o_orderdate DESC, o_orderkey) rn
  FROM orders) ON o_custkey = c_custkey AND rn = 1
""")
def lookup_by_priority(spark, sf):
    facts = given(spark, sf, "customer").select("c_custkey", "c_name")
    dim = given(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    status = F.col("o_orderstatus")
    return lookup_priority(facts, dim, ["c_custkey"], [
        F.when(status == "O", 0).otherwise(1), F.when(status == "P", 0).otherwise(1),
        F.desc(field_rank(F.col("o_orderpriority"), "1-URGENT", "2-HIGH")), F.desc("o_orderdate"),
        F.col("o_orderkey")], ["o_orderkey", "o_orderpriority"])


@query("""
WITH asked AS (
  SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE CAST(n_nationkey AS VARCHAR) END AS asked_for
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT s_suppkey, s_name FROM supplier)
SELECT c_custkey, asked_for, n_regionkey FROM asked LEFT JOIN nation
ON asked_for = n_name OR asked_for = CAST(n_nationkey AS VARCHAR)
""")
def lookup_by_any_key(spark, sf):
    nation = given(spark, sf, "nation")
    customer = given(spark, sf, "customer")
    facts = (customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
             .select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("n_name"))
                     .otherwise(F.col("n_nationkey").cast("string")).alias("asked_for"))
             .unionAll(given(spark, sf, "supplier").select("s_suppkey", "s_name")))
    return lookup_any_key(facts, given(spark, sf, "nation"), "asked_for", ["n_name", "n_nationkey"], "n_regionkey")


@query("SELECT event_id, 'k' AS path, props ->> '$.k' AS value FROM events")
def flatten_json_props(spark, sf):
    return flatten_json(given(spark, sf, "events"), "event_id", "props")


_NESTED = """to_json(named_struct('key', o_orderkey, 'dates', array(named_struct('day', string(o_orderdate)),
             named_struct('day', o_orderpriority)), 'who', named_struct('status', o_orderstatus, 'open', o_orderkey > 0,
             'lists', array(array(o_custkey, o_custkey + 1), array(o_custkey + 2)))))"""


@query("""
SELECT o_orderkey, path, value FROM (
  SELECT o_orderkey, unnest(['key', 'dates[0].day', 'dates[1].day', 'who.status', 'who.open', 'who.lists[0][0]',
                             'who.lists[0][1]', 'who.lists[1][0]']) AS path,
         unnest([CAST(o_orderkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority,
                 o_orderstatus, CASE WHEN o_orderkey > 0 THEN 'true' ELSE 'false' END, CAST(o_custkey AS VARCHAR),
                 CAST(o_custkey + 1 AS VARCHAR), CAST(o_custkey + 2 AS VARCHAR)]) AS value
  FROM orders)
""")
def flatten_json_nested(spark, sf):
    docs = given(spark, sf, "orders").select("o_orderkey", F.expr(_NESTED).alias("doc"))
    return flatten_json(docs, "o_orderkey", "doc")


@query("""
SELECT o_orderkey, path, value FROM (
  SELECT o_orderkey, unnest(['dates[0].day', 'dates[1].day', 'who.status']) AS path,
         unnest([strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority, o_orderstatus]) AS value
  FROM orders)
""")
def flatten_json_text_only(spark, sf):
    docs = given(spark, sf, "orders").select("o_orderkey", F.expr(_NESTED).alias("doc"))
    return flatten_json(docs, "o_orderkey", "doc", text_only=True)


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE repeat('a"[.b[0].', CAST(o_orderkey % 19 - 1 AS INTEGER)) || 'a"[.b[0]' END AS path,
       CAST(o_custkey AS VARCHAR) AS value FROM orders
""")
def flatten_json_deep(spark, sf):
    """Nested up to 36 levels deep, with brackets in names."""
    level = F.expr("int(o_orderkey % 19)")
    doc = F.concat(F.expr(r"""repeat('{"a\\"[": {"b": [', int(o_orderkey % 19))"""), F.col("o_custkey").cast("string"), F.repeat(F.lit("]}}"), level))
    return flatten_json(given(spark, sf, "orders").select("o_orderkey", doc.alias("doc")), "o_orderkey", "doc")


@query("SELECT 16 AS splits, count(*) AS rows_total, true AS even FROM lineitem")
def splits_of_uneven_keys(spark, sf):
    """Keys far from evenly spaced, split by quantiles; no part has more than 1.2 times the mean."""
    rows = given(spark, sf, "lineitem").select((F.pow(F.col("l_orderkey").cast("double"), F.lit(4.0)) + F.col("l_linenumber")).alias("k"))
    predicates = split_predicates("k", even_bounds(rows, "k", 16))
    part = F.coalesce(*[F.when(F.expr(p), i) for i, p in enumerate(predicates)])
    each = rows.groupBy(part.alias("part")).count()
    return each.agg(F.count(F.lit(1)).cast("int").alias("splits"), F.sum("count").alias("rows_total"), (F.max("count") <= 1.2 * F.avg("count")).alias("even"))


@query("""
SELECT doc_id, left(text, 1000) AS message, coalesce(nullif(lang, 'en'), source, '(unknown)') AS label,
       'doc-' || CAST(doc_id AS VARCHAR) || '@' || source AS tag,
       CASE source WHEN 'web' THEN 1 WHEN 'news' THEN 2 ELSE 0 END AS place,
       CASE WHEN lang IS NULL THEN 'none' ELSE lang END AS lang_or_none
FROM documents
""")
def scalar_text(spark, sf):
    lang, source = F.col("lang"), F.col("source")
    return given(spark, sf, "documents").select(
        "doc_id", clip_message(F.col("text")).alias("message"),
        label(F.nullif(lang, F.lit("en")), source).alias("label"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit("@"), source).alias("tag"),
        field_rank(source, "web", "news").alias("place"), F.nvl(lang, F.lit("none")).alias("lang_or_none"))


@query("""
SELECT c_custkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def lookup_ignoring_case(spark, sf):
    """Nations are asked for by names written in lower case."""
    nation = given(spark, sf, "nation")
    facts = given(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.lower("n_name").alias("asked_for"))
    found = lookup_any_key(facts, nation, "asked_for", ["n_name", "n_nationkey"], "n_regionkey", ignore_case=True)
    return found.select("c_custkey", "n_regionkey")


@query("""
SELECT * FROM (VALUES (1, 'o_orderkey', 'bigint'), (2, 'priority', 'string')) d(pos, name, type),
LATERAL (SELECT count(CASE d.name WHEN 'o_orderkey' THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderpriority END) AS values_held FROM orders)
""")
def describe_query_of_orders(spark, sf):
    """The columns a query would return, with the number of values each holds."""
    views(spark, sf, "orders")
    text = "SELECT o_orderkey, o_orderpriority AS priority FROM orders"
    rows = spark.sql(text)
    held = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "name", "values_held")
    return describe_query(spark, text).join(held, "name")
