"""Questions about run history.

A history is a DataFrame of runs: uuid, job_path, parent_execution_uuid, sequence_num, description, initiated,
started, completed, status, error_message, config. Runs form trees through the parent column.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablehaul.errors import LoadError
from tablehaul.functions.dates import duration_seconds, format_duration, ntz
from tablehaul.functions.text import label
from tablehaul.operators.shape import first_per_key
from tablehaul.workspace import materialize

SCHEMA = ("uuid string, job_path string, parent_execution_uuid string, sequence_num int, description string, "
          "initiated timestamp_ntz, started timestamp_ntz, completed timestamp_ntz, status string, "
          "error_message string, config string")

# The states a run can be in, and those it does not leave by itself.
STATUSES = ("INITIATED", "QUEUED", "IN_PROGRESS", "FAILED_WILL_RETRY", "RETRY_QUEUED", "SUCCEEDED", "FAILED", "ABORTED")
TERMINAL = ("SUCCEEDED", "FAILED", "ABORTED")

PARENT = "parent_execution_uuid"


def unknown_status(h: DataFrame) -> DataFrame:
    """Runs whose status is none of the known ones."""
    return h.where(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)))


def top_level(h: DataFrame) -> DataFrame:
    """Runs started by path, newest first."""
    return h.where(F.col("job_path").isNotNull()).orderBy(F.desc("initiated"), "uuid")


def runs_of(h: DataFrame, job_path: str) -> DataFrame:
    """Runs of one path, newest start first."""
    return h.where(F.col("job_path") == job_path).orderBy(F.desc("started"), "uuid")


def latest(h: DataFrame) -> DataFrame:
    """The most recently started run of every path."""
    return first_per_key(h.where(F.col("job_path").isNotNull()), ["job_path"], [F.desc_nulls_last("started"), F.col("uuid")])


def children(h: DataFrame, uuid: str | None = None) -> DataFrame:
    """Children of one run in order; of every run when none is named."""
    if uuid is None:
        return h.where(F.col(PARENT).isNotNull()).orderBy(PARENT, "sequence_num", "uuid")
    return h.where(F.col(PARENT) == uuid).orderBy("sequence_num", "uuid")


def unfinished(h: DataFrame) -> DataFrame:
    return h.where(F.col("completed").isNull())


def abort_hung(h: DataFrame, now: dt.datetime) -> DataFrame:
    """The history with every unfinished run completed now as ABORTED."""
    open_run = F.col("completed").isNull()
    return h.withColumns({
        "status": F.when(open_run, F.lit("ABORTED")).otherwise(F.col("status")),
        "completed": F.when(open_run, ntz(now)).otherwise(F.col("completed")),
    })


def with_duration(h: DataFrame, now: dt.datetime) -> DataFrame:
    """Add the run's label, its whole seconds (to now while it runs) and the same as text."""
    started = F.col("started")
    seconds = duration_seconds(started, F.coalesce(F.col("completed"), ntz(now)))
    return h.withColumns({
        "label": label(F.col("job_path"), F.col("description")),
        "duration_seconds": seconds,
        "duration": format_duration(started, seconds),
    })


def _round(state: DataFrame) -> tuple[DataFrame, int]:
    """Write one round's state and count, in the same pass, the runs that have not reached their root."""
    seen = Observation()
    written = materialize(state.observe(seen, F.count_if(F.col("root_uuid").isNull()).alias("left")), "ancestry")
    return written, seen.get["left"]


def _walk(inner: DataFrame, roots: DataFrame, carried: list[str]) -> DataFrame:
    """The roots, and every run of ``inner`` with its root, by rounds that double the known distance."""
    parents = inner.select("uuid", "flag").unionByName(roots.select("uuid", "flag")).select(
        F.col("uuid").alias("up"), F.col("flag").alias("up_flag"))
    found = F.col("up_flag").isNotNull()
    state, left = _round(inner.join(parents, "up", "left").select(
        "uuid",
        F.when(found, F.col("up")).alias("up"),
        F.when(~found, F.col("uuid")).alias("root_uuid"),
        F.when(found, 1).otherwise(0).alias("depth"),
        F.coalesce("up_flag", F.lit(False)).alias("flagged"), *carried))
    settled = [roots.withColumn("up", F.lit(None).cast("string")), state.where("root_uuid IS NOT NULL")]
    active = state.where("root_uuid IS NULL")
    while left:
        known = reduce(DataFrame.unionByName, settled).unionByName(active)
        above = known.drop("flag").select([F.col(c).alias("up" if c == "uuid" else f"next_{c}")
                                           for c in known.columns if c != "flag"])
        before = left
        longer = [F.concat("next_path", "path").alias("path")] if "path" in carried else []
        state, left = _round(active.drop("root_uuid").join(above, "up").select(
            "uuid", F.col("next_up").alias("up"), F.col("next_root_uuid").alias("root_uuid"),
            (F.col("depth") + F.col("next_depth")).alias("depth"),
            (F.col("flagged") | F.col("next_flagged")).alias("flagged"), "flag", *longer))
        settled.append(state.where("root_uuid IS NOT NULL"))
        active = state.where("root_uuid IS NULL")
        if left == before:
            raise LoadError(f"{left} runs are their own ancestors")
    return reduce(DataFrame.unionByName, settled).drop("up")


def ancestry(h: DataFrame, flag: Column | None = None, *, paths: bool = False) -> DataFrame:
    """``uuid, root_uuid, depth, flag, flagged`` for every run, and ``path`` if asked for.

    ``flag`` tells whether the condition holds for the run itself, ``flagged`` whether it holds for any run above it.
    ``path`` lists (sequence number, uuid) from the root down, so sorting by it walks the tree in order, runs with equal
    numbers kept apart. A run whose parent is not in the history counts as a root.

    The columns needed are stored once. Runs without children, mostly the greater part, and roots take no part in the
    rounds: the former are joined once, with their finished parent. The others double the distance that is known, so a
    tree of depth d takes about log2(d) rounds, each written once to the shared folder.
    """
    condition = F.coalesce(flag if flag is not None else F.lit(False), F.lit(False))
    place = [F.array(F.struct("sequence_num", "uuid")).alias("path")] if paths else []
    carried = ["flag", "path"] if paths else ["flag"]
    runs = materialize(h.select("uuid", F.col(PARENT).alias("up"), condition.alias("flag"), *place), "runs")
    roots = runs.where("up IS NULL").select("uuid", F.col("uuid").alias("root_uuid"), F.lit(0).alias("depth"),
                                            F.lit(False).alias("flagged"), *carried)
    below = runs.where("up IS NOT NULL")
    parents = below.select(F.col("up").alias("uuid")).distinct()
    inner = _walk(below.join(parents, "uuid", "left_semi"), roots, carried)
    above = inner.select([F.col(c).alias("up" if c == "uuid" else f"up_{c}") for c in inner.columns])
    found = F.col("up_flag").isNotNull()
    longer = [F.when(found, F.concat("up_path", "path")).otherwise(F.col("path")).alias("path")] if paths else []
    leaves = below.join(parents, "uuid", "left_anti").join(above, "up", "left").select(
        "uuid", F.when(found, F.col("up_root_uuid")).otherwise(F.col("uuid")).alias("root_uuid"),
        F.when(found, F.col("up_depth") + 1).otherwise(0).alias("depth"),
        F.coalesce(F.col("up_flagged") | F.col("up_flag"), F.lit(False)).alias("flagged"), "flag", *longer)
    return inner.unionByName(leaves)


def _below(h: DataFrame, root: str, flag: Column | None = None) -> DataFrame:
    """``uuid, up, root_uuid, depth, path, flag, flagged`` of ``root`` and the runs below it, as ``ancestry`` gives them.

    What a level needs of the history is stored once. Then every level is one job: it joins these columns with the few runs of the
    last level, which hand on what they know of the way down. What lies above ``root`` is not asked about.
    """
    condition = F.coalesce(flag if flag is not None else F.lit(False), F.lit(False))
    runs = h.select("uuid", F.col(PARENT).alias("up"), F.array(F.struct("sequence_num", "uuid")).alias("path"), condition.alias("flag"))
    links = materialize(runs.where((F.col("uuid") == root) | F.col("up").isNotNull()), "links")
    top = links.where(F.col("uuid") == root).select("uuid", F.lit(None).cast("string").alias("up"), F.lit(root).alias("root_uuid"),
                                                    F.lit(0).alias("depth"), "path", "flag", F.lit(False).alias("flagged"))
    levels = []
    while True:
        seen = Observation()
        level = materialize(top.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if((F.col("uuid") == root) & (F.col("depth") > 0)).alias("again")), "level")
        if seen.get["again"]:
            raise LoadError(f"{root} is its own ancestor")
        levels.append(level)
        if not seen.get["n"]:
            return reduce(DataFrame.unionByName, levels)
        last = level.select(F.col("uuid").alias("up"), "root_uuid", "depth", F.col("path").alias("up_path"), (F.col("flagged") | F.col("flag")).alias("flagged"))
        top = links.join(last, "up").select("uuid", "up", "root_uuid", (F.col("depth") + 1).alias("depth"), F.concat("up_path", "path").alias("path"),
                                            "flag", "flagged")


def _of_run(h: DataFrame, root: str) -> DataFrame:
    """The history with nothing above ``root``."""
    return h.withColumn(PARENT, F.when(F.col("uuid") != root, F.col(PARENT)))


def tree(h: DataFrame, root: str | None = None) -> DataFrame:
    """Every run with its root, depth and place in the tree; order by ``root_uuid, path`` to print it. With ``root`` only that
    run and what is below it."""
    if root is not None:
        return _of_run(h, root).join(_below(h, root).select("uuid", "root_uuid", "depth", "path"), "uuid")
    return h.join(ancestry(h, paths=True).select("uuid", "root_uuid", "depth", "path"), "uuid")


def root_of(h: DataFrame, uuid: str | None = None) -> DataFrame:
    """The root of every run, or of one: then its way up is looked up run by run. A parent that is not in the history is none."""
    if uuid is None:
        return ancestry(h).select("uuid", "root_uuid")
    links = materialize(h.select("uuid", F.col(PARENT).alias("up")), "links")
    way: list[str] = []
    at = links.where(F.col("uuid") == uuid).first()
    while at is not None:
        if at["uuid"] in way:
            raise LoadError(f"{at['uuid']} is its own ancestor")
        way.append(at["uuid"])
        at = links.where(F.col("uuid") == at["up"]).first() if at["up"] is not None else None
    return h.sparkSession.createDataFrame([(uuid, way[-1])] if way else [], "uuid string, root_uuid string")


def progress(h: DataFrame, root: str | None = None) -> DataFrame:
    """For every root, or for one run: how many of its descendants there are and how many have come to an end."""
    ended = F.col("status").isin(*TERMINAL)
    places = ancestry(h, ended) if root is None else _below(h, root, ended)
    return (places.groupBy("root_uuid").agg(F.count_if((F.col("depth") > 0) & F.col("flag")).alias("complete"),
                                            F.count_if(F.col("depth") > 0).alias("total")))


def child_errors(h: DataFrame) -> DataFrame:
    """For every run with children: how many failed out of how many."""
    return (h.where(F.col(PARENT).isNotNull()).groupBy(F.col(PARENT).alias("uuid"))
            .agg(F.count_if(F.col("status") == "FAILED").alias("failed"), F.count(F.lit(1)).alias("total")))


def leaf_failures(h: DataFrame, root: str | None = None) -> DataFrame:
    """Failed runs that are a cause rather than a consequence: none of their children failed.

    Below such a run nothing more is reported. With ``root`` only that run and what is below it.
    """
    failed = F.col("status") == "FAILED"
    if root is not None:
        runs = _below(h, root, failed)
        causes = runs.where("flag").join(runs.where("flag AND up IS NOT NULL").select(F.col("up").alias("uuid")), "uuid", "left_anti").select("uuid", "path")
        above = causes.select("uuid", F.explode(F.slice("path", 1, F.size("path") - 1)["uuid"]).alias("above"))
        explained = above.join(causes.select(F.col("uuid").alias("above")), "above", "left_semi")
        return _of_run(h, root).join(causes.join(explained, "uuid", "left_anti").select("uuid"), "uuid", "left_semi")
    with_failed_child = (h.where(failed & F.col(PARENT).isNotNull())
                         .select(F.col(PARENT).alias("uuid"), F.lit(True).alias("explained")).distinct())
    judged = h.select("uuid", PARENT, "status").join(with_failed_child, "uuid", "left")
    causes = ancestry(judged, failed & F.col("explained").isNull()).where("flag AND NOT flagged")
    return h.join(causes.select("uuid"), "uuid", "left_semi")


def remaining(h: DataFrame, root: str | None = None) -> DataFrame:
    """The single steps still to be done: runs without children that did not succeed, nor did any run above them.

    With ``root`` only the work below that run, else that of all trees. Sort by ``root_uuid, path`` for the order of
    execution.
    """
    done = F.col("status") == "SUCCEEDED"
    if root is not None:
        runs = _below(h, root, done)
        steps = runs.where("NOT flag AND NOT flagged").join(runs.where("up IS NOT NULL").select(F.col("up").alias("uuid")), "uuid", "left_anti")
        return _of_run(h, root).join(steps.select("uuid", "root_uuid", "depth", "path"), "uuid")
    parents = h.where(F.col(PARENT).isNotNull()).select(F.col(PARENT).alias("uuid")).distinct()
    steps = h.where(~F.col("status").eqNullSafe("SUCCEEDED")).join(parents, "uuid", "left_anti")
    places = ancestry(h, done, paths=True).where(~F.col("flagged"))
    return steps.join(places.select("uuid", "root_uuid", "depth", "path"), "uuid")
