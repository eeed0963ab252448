"""Run history: orders as runs with line items as steps, and a tree of regions, nations, customers and orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tablehaul.operators import history as runs
from tablehaul.sources import scalar
from tablehaul.workspace import materialize
from workload.registry import given, query

NOW = datetime(2003, 1, 1, 12, 0, 0)
NOW_SQL = "TIMESTAMP '2003-01-01 12:00:00'"

STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCEEDED' ELSE 'IN_PROGRESS' END"
RUNS_SQL = f"""runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS uuid, 'path ' || CAST(o_custkey AS VARCHAR) AS job_path,
         o_orderpriority AS description, o_orderdate AS started, {STATUS_SQL} AS status,
         CASE WHEN o_orderstatus <> 'P' THEN (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey) END
         AS completed
  FROM orders)"""


def _order_status():
    return (F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderstatus") == "O", "SUCCEEDED")
            .otherwise("IN_PROGRESS"))


def _orders(spark, sf):
    """Every order is a run of its customer's path, completed when its last item was shipped."""
    orders = given(spark, sf, "orders")
    shipped = (given(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
               .agg(F.max("l_shipdate").alias("shipped")))
    return orders.join(shipped, "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("uuid"),
        F.concat(F.lit("path "), F.col("o_custkey").cast("string")).alias("job_path"),
        F.col("o_orderpriority").alias("description"), F.col("o_orderdate").alias("started"),
        F.col("o_orderdate").alias("initiated"), _order_status().alias("status"),
        F.when(F.col("o_orderstatus") != "P", F.col("shipped")).alias("completed"))


def _steps(spark, sf):
    """Line items as the steps of their order."""
    item = given(spark, sf, "lineitem")
    return item.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("uuid"),
        F.col("l_orderkey").cast("string").alias("parent_execution_uuid"), F.col("l_linenumber").alias("sequence_num"),
        F.when(F.col("l_linestatus") == "F", "FAILED").otherwise("SUCCEEDED").alias("status"))


@query(f"WITH {RUNS_SQL} SELECT uuid, job_path, started AS initiated FROM runs WHERE job_path IS NOT NULL ORDER BY 3 DESC, 1")
def history_top_level(spark, sf):
    return runs.top_level(_orders(spark, sf)).select("uuid", "job_path", "initiated")


@query(f"""
WITH {RUNS_SQL} SELECT job_path, uuid, started FROM (
  SELECT *, row_number() OVER (PARTITION BY job_path ORDER BY started DESC, uuid) rn FROM runs) WHERE rn = 1
""")
def history_latest(spark, sf):
    return runs.latest(_orders(spark, sf)).select("job_path", "uuid", "started")


@query(f"WITH {RUNS_SQL} SELECT uuid, started FROM runs WHERE job_path = 'path 42' ORDER BY started DESC, uuid")
def history_of_path(spark, sf):
    return runs.runs_of(_orders(spark, sf), "path 42").select("uuid", "started")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS parent_execution_uuid, l_linenumber AS sequence_num,
       CASE l_linestatus WHEN 'F' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status
FROM lineitem ORDER BY 1, 2
""")
def history_children(spark, sf):
    return runs.children(_steps(spark, sf)).select("parent_execution_uuid", "sequence_num", "status")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS uuid, count(*) FILTER (l_linestatus = 'F') AS failed, count(*) AS total
FROM lineitem GROUP BY l_orderkey
""")
def history_child_errors(spark, sf):
    return runs.child_errors(_steps(spark, sf))


@query(f"""
WITH {RUNS_SQL}, timed AS (
  SELECT *, CAST(trunc(epoch(coalesce(completed, {NOW_SQL})) - epoch(started)) AS BIGINT) AS s FROM runs)
SELECT uuid, job_path AS label, s AS duration_seconds,
       CASE WHEN s >= 3600 THEN printf('%dh %02dm %02ds', s // 3600, (s % 3600) // 60, s % 60)
            WHEN s >= 60 THEN printf('%dm %02ds', s // 60, s % 60) ELSE printf('%ds', s % 60) END AS duration
FROM timed
""")
def history_durations(spark, sf):
    return runs.with_duration(_orders(spark, sf), NOW).select("uuid", "label", "duration_seconds", "duration")


@query(f"WITH {RUNS_SQL} SELECT uuid, status FROM runs WHERE completed IS NULL")
def history_unfinished(spark, sf):
    return runs.unfinished(_orders(spark, sf)).select("uuid", "status")


@query(f"""
WITH {RUNS_SQL} SELECT uuid, CASE WHEN completed IS NULL THEN 'ABORTED' ELSE status END AS status,
       coalesce(completed, {NOW_SQL}) AS completed FROM runs
""")
def history_abort_hung(spark, sf):
    return runs.abort_hung(_orders(spark, sf), NOW).select("uuid", "status", "completed")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS uuid, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'F'")
def history_unknown_status(spark, sf):
    raw = _orders(spark, sf).select("uuid", "status")
    raw = raw.withColumn("status", F.when(F.col("status") == "SUCCEEDED", "O")
                         .when(F.col("status") == "IN_PROGRESS", "P").otherwise(F.col("status")))
    return runs.unknown_status(raw)


NODES_SQL = f"""nodes AS (
  SELECT 'r' || CAST(r_regionkey AS VARCHAR) AS uuid, NULL AS parent, r_regionkey AS seq,
         CASE WHEN r_regionkey % 2 = 0 THEN 'FAILED' ELSE 'IN_PROGRESS' END AS status FROM region
  UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'r' || CAST(n_regionkey AS VARCHAR), n_nationkey,
         CASE n_nationkey % 3 WHEN 0 THEN 'SUCCEEDED' WHEN 1 THEN 'FAILED' ELSE 'ABORTED' END FROM nation
  UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'n' || CAST(c_nationkey AS VARCHAR), CAST(c_custkey AS INTEGER),
         CASE WHEN c_acctbal < 0 THEN 'FAILED' WHEN c_custkey % 4 = 0 THEN 'SUCCEEDED' ELSE 'ABORTED' END FROM customer
  UNION ALL SELECT 'o' || CAST(o_orderkey AS VARCHAR), 'c' || CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS INTEGER),
         {STATUS_SQL} FROM orders)"""

WALK_SQL = f"""WITH RECURSIVE {NODES_SQL}, walk AS (
  SELECT uuid, status, uuid AS root_uuid, 0 AS depth, CAST(seq AS VARCHAR) AS path FROM nodes WHERE parent IS NULL
  UNION ALL
  SELECT n.uuid, n.status, w.root_uuid, w.depth + 1, w.path || '/' || CAST(n.seq AS VARCHAR)
  FROM nodes n JOIN walk w ON n.parent = w.uuid)"""


def _tree(spark, sf):
    """A stored history of four levels."""
    def node(prefix, key, parent_prefix, parent, status):
        above = F.concat(F.lit(parent_prefix), F.col(parent).cast("string")) if parent else F.lit(None).cast("string")
        return [F.concat(F.lit(prefix), F.col(key).cast("string")).alias("uuid"),
                above.alias("parent_execution_uuid"), F.col(key).cast("int").alias("sequence_num"),
                status.alias("status")]

    region = given(spark, sf, "region").select(node("r", "r_regionkey", None, None, F.when(
        F.col("r_regionkey") % 2 == 0, "FAILED").otherwise("IN_PROGRESS")))
    third = F.col("n_nationkey") % 3
    nation = given(spark, sf, "nation").select(node("n", "n_nationkey", "r", "n_regionkey", F.when(
        third == 0, "SUCCEEDED").when(third == 1, "FAILED").otherwise("ABORTED")))
    customer = given(spark, sf, "customer").select(node("c", "c_custkey", "n", "c_nationkey", F.when(
        F.col("c_acctbal") < 0, "FAILED").when(F.col("c_custkey") % 4 == 0, "SUCCEEDED").otherwise("ABORTED")))
    orders = given(spark, sf, "orders").select(node("o", "o_orderkey", "c", "o_custkey", _order_status()))
    return materialize(region.unionByName(nation).unionByName(customer).unionByName(orders), "history")


def _numbers(path):
    return F.array_join(F.transform(path, lambda p: p["sequence_num"].cast("string")), "/")


def _tied(spark, sf):
    """The same tree with step numbers that repeat among the children of a run."""
    return _tree(spark, sf).withColumn("sequence_num", F.col("sequence_num") % 3)


@query(f"{WALK_SQL} SELECT uuid, root_uuid, depth, path FROM walk")
def history_tree(spark, sf):
    return runs.tree(_tree(spark, sf)).select("uuid", "root_uuid", "depth", _numbers("path").alias("path"))


@query(f"{WALK_SQL} SELECT uuid, root_uuid FROM walk")
def history_root(spark, sf):
    return runs.root_of(_tree(spark, sf))


@query(f"""
{WALK_SQL} SELECT root_uuid, count(*) FILTER (depth > 0 AND status IN ('SUCCEEDED', 'FAILED', 'ABORTED')) AS complete,
       count(*) FILTER (depth > 0) AS total FROM walk GROUP BY root_uuid
""")
def history_progress(spark, sf):
    return runs.progress(_tree(spark, sf))


@query(f"""
WITH RECURSIVE {NODES_SQL}, causes AS (
  SELECT uuid FROM nodes WHERE status = 'FAILED'
  AND uuid NOT IN (SELECT parent FROM nodes WHERE status = 'FAILED' AND parent IS NOT NULL)),
walk AS (
  SELECT n.uuid, c.uuid IS NOT NULL AS cause, false AS below FROM nodes n LEFT JOIN causes c USING (uuid)
  WHERE parent IS NULL
  UNION ALL
  SELECT n.uuid, n.uuid IN (SELECT uuid FROM causes), w.below OR w.cause FROM nodes n JOIN walk w ON n.parent = w.uuid)
SELECT uuid FROM walk WHERE cause AND NOT below
""")
def history_leaf_failures(spark, sf):
    return runs.leaf_failures(_tree(spark, sf)).select("uuid")


_REMAINING_SQL = f"""
WITH RECURSIVE {NODES_SQL}, walk AS (
  SELECT uuid, status, uuid AS root_uuid, false AS done FROM nodes WHERE parent IS NULL
  UNION ALL
  SELECT n.uuid, n.status, w.root_uuid, w.done OR w.status = 'SUCCEEDED' FROM nodes n JOIN walk w ON n.parent = w.uuid)
SELECT uuid, root_uuid, status FROM walk
WHERE NOT done AND status <> 'SUCCEEDED' AND uuid NOT IN (SELECT parent FROM nodes WHERE parent IS NOT NULL)
"""


@query(_REMAINING_SQL)
def history_remaining(spark, sf):
    return runs.remaining(_tree(spark, sf)).select("uuid", "root_uuid", "status")


@query(_REMAINING_SQL + " AND root_uuid = 'r1'")
def history_remaining_of_run(spark, sf):
    return runs.remaining(_tree(spark, sf), "r1").select("uuid", "root_uuid", "status")


_RUN_SQL = f"""WITH RECURSIVE {NODES_SQL}, walk AS (
  SELECT uuid, parent, status, 0 AS depth, CAST(seq % 3 AS VARCHAR) || ' ' || uuid AS path FROM nodes WHERE uuid = 'r1'
  UNION ALL
  SELECT n.uuid, n.parent, n.status, w.depth + 1, w.path || '/' || CAST(n.seq % 3 AS VARCHAR) || ' ' || n.uuid
  FROM nodes n JOIN walk w ON n.parent = w.uuid)"""


@query(f"{_RUN_SQL} SELECT uuid, 'r1' AS root_uuid, depth, path FROM walk")
def history_tree_of_run(spark, sf):
    named = F.transform("path", lambda p: F.concat(p["sequence_num"].cast("string"), F.lit(" "), p["uuid"]))
    return runs.tree(_tied(spark, sf), "r1").select("uuid", "root_uuid", "depth", F.array_join(named, "/").alias("path"))


@query(f"""
{_RUN_SQL} SELECT 'r1' AS root_uuid, count(*) FILTER (depth > 0 AND status IN ('SUCCEEDED', 'FAILED', 'ABORTED')) AS complete,
       count(*) FILTER (depth > 0) AS total FROM walk
""")
def history_progress_of_run(spark, sf):
    return runs.progress(_tied(spark, sf), "r1")


@query(f"""
{_RUN_SQL}, causes AS (
  SELECT uuid FROM walk WHERE status = 'FAILED'
  AND uuid NOT IN (SELECT parent FROM walk WHERE status = 'FAILED' AND parent IS NOT NULL AND uuid <> 'r1')),
down AS (
  SELECT w.uuid, w.uuid IN (SELECT uuid FROM causes) AS cause, false AS below FROM walk w WHERE uuid = 'r1'
  UNION ALL
  SELECT n.uuid, n.uuid IN (SELECT uuid FROM causes), d.below OR d.cause FROM walk n JOIN down d ON n.parent = d.uuid)
SELECT uuid FROM down WHERE cause AND NOT below
""")
def history_failures_of_run(spark, sf):
    return runs.leaf_failures(_tied(spark, sf), "r1").select("uuid")


@query(f"""
WITH RECURSIVE {NODES_SQL}, up AS (
  SELECT uuid, parent, uuid AS start FROM nodes WHERE uuid = (SELECT 'o' || CAST(max(o_orderkey) AS VARCHAR) FROM orders)
  UNION ALL
  SELECT n.uuid, n.parent, u.start FROM nodes n JOIN up u ON n.uuid = u.parent)
SELECT start AS uuid, uuid AS root_uuid FROM up WHERE parent IS NULL
""")
def history_root_of_run(spark, sf):
    last = scalar(given(spark, sf, "orders").agg(F.max("o_orderkey")))
    return runs.root_of(_tree(spark, sf), f"o{last}")
