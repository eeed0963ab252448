"""Incremental refresh: customers as data, events as the change log. Each query returns the refreshed table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablehaul.plans.jobs import bulk_import
from tablehaul.streaming import incremental_load_partitions
from workload.registry import given, query, target

SCHEMA = "c_custkey bigint, c_name varchar(100), c_acctbal double, message varchar(20), partition_num int"
FIRST = "ts <= TIMESTAMP '2024-01-15 00:00:00'"
PREVIOUS = f"(SELECT max(ts) FROM events WHERE {FIRST})"
CHANGED = f"c_custkey IN (SELECT user_id FROM events WHERE ts >= {PREVIOUS})"


def _customers(spark, sf):
    return given(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def _changes(spark, sf):
    return given(spark, sf, "events").select(F.col("user_id").alias("c_custkey"), "ts")


def _refresh(spark, table, rows, changes, partition=1):
    return bulk_import(spark, rows, table, schema=SCHEMA, partition=("partition_num", partition), incremental={
        "changes": changes, "key": "c_custkey", "changed_at": "ts", "log_table": f"{table}_log", "mark": "message"})


@query("SELECT c_custkey, c_name, c_acctbal, 'initial-load' AS message, 1 AS partition_num FROM customer")
def incremental_initial(spark, sf):
    table = target(spark)
    _refresh(spark, table, _customers(spark, sf), _changes(spark, sf))
    return spark.table(table)


def _two_runs(spark, sf, second_rows):
    table = target(spark)
    changes = _changes(spark, sf)
    _refresh(spark, table, _customers(spark, sf), changes.where(FIRST))
    done = _refresh(spark, table, second_rows, changes)
    return table, done


@query(f"""
SELECT c_custkey, c_name, CASE WHEN {CHANGED} THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN {CHANGED} THEN 'incremental-load' ELSE 'initial-load' END AS message, 1 AS partition_num
FROM customer
""")
def incremental_delta(spark, sf):
    richer = _customers(spark, sf).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return spark.table(_two_runs(spark, sf, richer)[0])


@query(f"""
SELECT count(*) AS rows_before, count(*) FILTER ({CHANGED}) AS rows_removed,
       count(*) FILTER ({CHANGED}) AS rows_added, count(*) AS rows_after FROM customer
""")
def incremental_delta_audit(spark, sf):
    done = _two_runs(spark, sf, _customers(spark, sf))[1]
    return done.select("rows_before", "rows_removed", "rows_added", "rows_after")


@query("""
WITH log AS (SELECT user_id, date_trunc('day', ts) AS day FROM events)
SELECT c_custkey, c_name, c_acctbal,
       CASE WHEN c_custkey IN (SELECT user_id FROM log WHERE day BETWEEN TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-16')
       THEN 'incremental-load' ELSE 'initial-load' END AS message, 1 AS partition_num FROM customer
""")
def incremental_boundary(spark, sf):
    """Whole days as change times, so that many changes lie exactly on each end of the window."""
    table = target(spark)
    changes = _changes(spark, sf).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    for until in ("2024-01-15", "2024-01-16"):
        _refresh(spark, table, _customers(spark, sf), changes.where(f"ts <= TIMESTAMP_NTZ '{until} 00:00:00'"))
    return spark.table(table)


@query("SELECT c_custkey, c_name, c_acctbal, 'initial-load' AS message, 1 AS partition_num FROM customer")
def incremental_noop(spark, sf):
    table = target(spark)
    changes = _changes(spark, sf)
    _refresh(spark, table, _customers(spark, sf), changes)
    _refresh(spark, table, _customers(spark, sf).where("c_acctbal > 0"), changes)
    return spark.table(table)


@query(f"""
SELECT c_custkey, c_name, c_acctbal, CASE WHEN {CHANGED} THEN 'incremental-load' ELSE 'initial-load' END AS message,
       1 AS partition_num
FROM customer WHERE NOT (c_mktsegment = 'BUILDING' AND {CHANGED})
""")
def incremental_source_delete(spark, sf):
    shrunk = given(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_acctbal")
    return spark.table(_two_runs(spark, sf, shrunk)[0])


@query(f"""
SELECT '1' AS partition_num, CAST(NULL AS TIMESTAMP) AS starting_watermark, {PREVIOUS} AS ending_watermark
UNION ALL SELECT '1', {PREVIOUS}, (SELECT max(ts) FROM events)
""")
def watermark_log(spark, sf):
    table, _ = _two_runs(spark, sf, _customers(spark, sf))
    return spark.table(f"{table}_log").select("partition_num", "starting_watermark", "ending_watermark")


@query(f"""
SELECT c_custkey, c_name, c_acctbal, CASE WHEN {CHANGED} THEN 'incremental-load' ELSE 'initial-load' END AS message,
       CASE WHEN n_regionkey < 2 THEN 1 ELSE 2 END AS partition_num
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey < 2
UNION ALL
SELECT c_custkey, c_name, c_acctbal, 'initial-load', 2 FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey >= 2
""")
def incremental_per_partition(spark, sf):
    """Two sources with watermarks of their own; only the first is refreshed again."""
    customer, nation = given(spark, sf, "customer"), given(spark, sf, "nation")
    located = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    near = located.where("n_regionkey < 2").select("c_custkey", "c_name", "c_acctbal")
    far = located.where("n_regionkey >= 2").select("c_custkey", "c_name", "c_acctbal")
    table = target(spark)
    changes = _changes(spark, sf)
    _refresh(spark, table, near, changes.where(FIRST), 1)
    _refresh(spark, table, far, changes, 2)
    _refresh(spark, table, near, changes, 1)
    return spark.table(table)


_NATION_CHANGED = """(SELECT c_nationkey AS nation, user_id, ts FROM events JOIN customer ON c_custkey = user_id
  WHERE c_nationkey % 5 <> 0 OR ts <= TIMESTAMP '2024-01-15 00:00:00')"""


@query(f"""
WITH log AS {_NATION_CHANGED},
mark AS (SELECT nation, max(ts) FILTER (ts <= TIMESTAMP '2024-01-15 00:00:00') AS before, max(ts) AS latest FROM log GROUP BY nation),
moved AS (SELECT DISTINCT log.nation, user_id FROM log JOIN mark USING (nation) WHERE latest > before AND ts >= before)
SELECT c_custkey, c_name, CASE WHEN user_id IS NULL AND before IS NOT NULL THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal,
       CASE WHEN user_id IS NULL OR before IS NULL THEN 'initial-load' ELSE 'incremental-load' END AS message, c_nationkey AS nation
FROM customer LEFT JOIN mark ON mark.nation = c_nationkey
LEFT JOIN moved ON user_id = c_custkey AND moved.nation = c_nationkey
WHERE (user_id IS NULL AND before IS NOT NULL) OR c_custkey % 7 <> 0
""")
def incremental_many_partitions(spark, sf):
    """25 partitions refreshed at once: some without changes, some without a mark, others with changed and deleted rows."""
    table = target(spark)
    customers = given(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.col("c_nationkey").alias("nation"))
    changes = given(spark, sf, "events").join(customers, F.col("user_id") == F.col("c_custkey")).select("c_custkey", "ts", "nation")
    changes = changes.where(f"nation % 5 <> 0 OR {FIRST}")
    options = {"key": "c_custkey", "changed_at": "ts", "target": table, "column": "nation", "values": list(range(25)),
               "log_table": f"{table}_log", "mark": "message"}
    incremental_load_partitions(spark, source=customers, changes=changes.where(FIRST), **options)
    later = customers.withColumn("c_acctbal", F.col("c_acctbal") + 1).where("c_custkey % 7 <> 0")
    incremental_load_partitions(spark, source=later, changes=changes, **options)
    return spark.table(table).select("c_custkey", "c_name", "c_acctbal", "message", "nation")


@query(f"""
SELECT 'Key-' || CAST(c_custkey AS VARCHAR) AS code, CASE WHEN {CHANGED} THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, 1 AS part
FROM customer
""")
def incremental_ignoring_case(spark, sf):
    """Rows and change log write their text keys differently."""
    from tablehaul.streaming import incremental_load

    table = target(spark)
    rows = given(spark, sf, "customer").select(F.concat(F.lit("Key-"), F.col("c_custkey").cast("string")).alias("code"), "c_acctbal")
    changes = given(spark, sf, "events").select(F.concat(F.lit("KEY-"), F.col("user_id").cast("string")).alias("code"), "ts")
    options = {"key": "code", "changed_at": "ts", "target": table, "partition": ("part", 1), "log_table": f"{table}_log", "ignore_case": True}
    incremental_load(spark, source=rows, changes=changes.where(FIRST), **options)
    incremental_load(spark, source=rows.withColumn("c_acctbal", F.col("c_acctbal") + 1), changes=changes, **options)
    return spark.table(table)


@query(f"""
SELECT md5('k' || CAST(c_custkey AS VARCHAR)) AS code, CASE WHEN {CHANGED} THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, 1 AS part
FROM customer WHERE NOT (c_mktsegment = 'BUILDING' AND {CHANGED})
""")
def incremental_text_keys(spark, sf):
    """Keys as random texts, which have no range: a Bloom filter of the changed ones keeps other rows out of the joins."""
    from tablehaul.streaming import incremental_load

    table = target(spark)
    rows = given(spark, sf, "customer").select(F.md5(F.concat(F.lit("k"), F.col("c_custkey").cast("string"))).alias("code"), "c_acctbal", "c_mktsegment")
    changes = given(spark, sf, "events").select(F.md5(F.concat(F.lit("k"), F.col("user_id").cast("string"))).alias("code"), "ts")
    options = {"key": "code", "changed_at": "ts", "target": table, "partition": ("part", 1), "log_table": f"{table}_log", "bloom_from": 1}
    incremental_load(spark, source=rows.drop("c_mktsegment"), changes=changes.where(FIRST), **options)
    later = rows.where("c_mktsegment <> 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 1).drop("c_mktsegment")
    incremental_load(spark, source=later, changes=changes, **options)
    return spark.table(table)


@query("SELECT c_custkey, c_name, c_acctbal, 'initial-load' AS message, 1 AS partition_num, 6 AS refused FROM customer")
def incremental_guards(spark, sf):
    """Loads that say too little, or that would change columns where that is refused, leave the table as it was."""
    from tablehaul.errors import LoadError
    from tablehaul.streaming import incremental_load

    table, rows, changes = target(spark), _customers(spark, sf), _changes(spark, sf)
    _refresh(spark, table, rows, changes)
    good = {"key": "c_custkey", "changed_at": "ts", "target": table, "partition": ("partition_num", 1), "log_table": f"{table}_log"}
    refused = 0
    for wrong in ({"key": []}, {"changed_at": ""}, {"log_table": ""}, {"partition": ("", 1)}, {"partition": ("partition_num", None)},
                  {"on_schema_change": "fail"}):
        try:
            incremental_load(spark, source=rows.drop("c_name"), changes=changes, **{**good, **wrong})
        except LoadError:
            refused += 1
    return spark.table(table).withColumn("refused", F.lit(refused))


@query(f"""
WITH log AS (SELECT c_nationkey % 5 AS part, user_id, ts FROM events JOIN customer ON c_custkey = user_id
  WHERE c_nationkey % 5 <> 0 OR ts <= TIMESTAMP '2024-01-15 00:00:00'),
mark AS (SELECT part, max(ts) FILTER (ts <= TIMESTAMP '2024-01-15 00:00:00') AS before, max(ts) AS latest FROM log GROUP BY part),
moved AS (SELECT DISTINCT log.part, user_id FROM log JOIN mark USING (part) WHERE latest > before AND ts >= before)
SELECT c_custkey, CASE WHEN user_id IS NULL THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal,
       CASE WHEN user_id IS NULL THEN 'initial-load' ELSE 'incremental-load' END AS message, CAST(c_nationkey % 5 AS INTEGER) AS part
FROM customer LEFT JOIN moved ON user_id = c_custkey WHERE user_id IS NULL OR c_custkey % 7 <> 0
""")
def incremental_from_marks(spark, sf):
    """The source is a function of the partitions' marks, which become one condition per partition, as a database is asked."""
    from functools import reduce

    from tablehaul.streaming import partition_predicates

    table, part = target(spark), (F.col("c_nationkey") % 5).cast("int").alias("part")
    customers = given(spark, sf, "customer").select("c_custkey", "c_acctbal", part)
    changes = given(spark, sf, "events").join(customers, F.col("user_id") == F.col("c_custkey")).select("c_custkey", "ts", "part").where(f"part <> 0 OR {FIRST}")
    given(spark, sf, "events").createOrReplaceTempView("change_log")

    def asked(rows):
        changed = "c_custkey IN (SELECT user_id FROM change_log WHERE ts BETWEEN TIMESTAMP_NTZ'{previous}' AND TIMESTAMP_NTZ'{new}')"
        return lambda marks: reduce(type(rows).unionByName, [rows.where(p) for p in partition_predicates(marks, "part", changed)])

    options = {"key": "c_custkey", "changed_at": "ts", "target": table, "column": "part", "values": list(range(5)), "log_table": f"{table}_log",
               "mark": "message", "schema": "c_custkey bigint, c_acctbal double, message string, part int"}
    incremental_load_partitions(spark, source=asked(customers), changes=changes.where(FIRST), **options)
    later = customers.withColumn("c_acctbal", F.col("c_acctbal") + 1).where("c_custkey % 7 <> 0")
    incremental_load_partitions(spark, source=asked(later), changes=changes, **options)
    return spark.table(table).select("c_custkey", "c_acctbal", "message", "part")
