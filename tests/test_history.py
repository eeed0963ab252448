import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from tablehaul import LoadError
from tablehaul.operators import history as runs

NOW = datetime(2024, 1, 2, 0, 0, 0)


def history(spark, rows):
    """Rows of (uuid, parent, sequence number, status)."""
    return spark.createDataFrame(rows, "uuid string, parent_execution_uuid string, sequence_num int, status string")


class Brute:
    """The same questions answered by walking one tree at a time."""

    def __init__(self, rows):
        self.rows = {r[0]: r for r in rows}

    def children(self, uuid):
        return [r for r in self.rows.values() if r[1] == uuid]

    def roots(self):
        return [r for r in self.rows.values() if r[1] not in self.rows]

    def walk(self, row, depth=0, path=()):
        path = (*path, row[2])
        yield row[0], depth, path
        for child in self.children(row[0]):
            yield from self.walk(child, depth + 1, path)

    def tree(self):
        return {uuid: (root[0], depth, path) for root in self.roots() for uuid, depth, path in self.walk(root)}

    def failures(self, row):
        below = self.children(row[0])
        if row[3] == "FAILED" and not any(c[3] == "FAILED" for c in below):
            return [row[0]]
        return [u for c in below for u in self.failures(c)]

    def remaining(self, row):
        if row[3] == "SUCCEEDED":
            return []
        below = self.children(row[0])
        return [u for c in below for u in self.remaining(c)] if below else [row[0]]


def random_forest(n, seed):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all runs hang below one parent; the rest anywhere before them.
        parent = None if i == 0 or pick.random() < 0.05 else "r0" if pick.random() < 0.33 else f"r{pick.randrange(i)}"
        rows.append((f"r{i}", parent, i, pick.choice(runs.STATUSES[-4:])))
    rows.append(("lost", "not recorded", 1, "FAILED"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_trees(spark, db, seed):
    rows = random_forest(150, seed)
    h, brute = history(spark, rows), Brute(rows)
    got = {r.uuid: (r.root_uuid, r.depth, tuple(p.sequence_num for p in r.path)) for r in runs.tree(h).collect()}
    assert got == brute.tree()
    assert values(runs.leaf_failures(h), "uuid") == sorted((u,) for r in brute.roots() for u in brute.failures(r))
    assert values(runs.remaining(h), "uuid") == sorted((u,) for r in brute.roots() for u in brute.remaining(r))
    assert values(runs.remaining(h, "r0"), "uuid") == sorted((u,) for u in brute.remaining(brute.rows["r0"]))
    want = []
    for root in brute.roots():
        below = [u for u, depth, _ in brute.walk(root) if depth]
        want.append((root[0], sum(brute.rows[u][3] in runs.TERMINAL for u in below), len(below)))
    assert values(runs.progress(h)) == sorted(want)


def test_long_chain(spark, db):
    h = history(spark, [(f"c{i:03}", f"c{i - 1:03}" if i else None, i, "FAILED") for i in range(70)])
    last = runs.tree(h).where("uuid = 'c069'").first()
    assert (last.root_uuid, last.depth, [p.sequence_num for p in last.path]) == ("c000", 69, list(range(70)))
    assert values(runs.leaf_failures(h), "uuid") == [("c069",)]
    assert values(runs.root_of(h).select("root_uuid").distinct()) == [("c000",)]


def test_a_circle_is_an_error(spark, db):
    h = history(spark, [("a", "b", 1, "FAILED"), ("b", "a", 1, "FAILED"), ("c", None, 1, "FAILED")])
    with pytest.raises(LoadError, match="2 runs are their own ancestors"):
        runs.tree(h)


def test_remaining_below_a_nested_run(spark, db):
    h = history(spark, [("p", None, 1, "FAILED"), ("a", "p", 1, "SUCCEEDED"), ("b", "p", 2, "FAILED"),
                        ("b1", "b", 1, "FAILED"), ("b2", "b", 2, "ABORTED"), ("a1", "a", 1, "FAILED"),
                        ("c", "p", 3, "ABORTED")])
    ordered = runs.remaining(h).orderBy("root_uuid", "path")
    assert [r.uuid for r in ordered.collect()] == ["b1", "b2", "c"]
    assert values(runs.remaining(h, "b"), "uuid") == [("b1",), ("b2",)]
    assert runs.remaining(h, "a").count() == 0
    assert values(runs.child_errors(h)) == [("a", 1, 1), ("b", 1, 2), ("p", 1, 3)]


def full(spark):
    day = datetime(2024, 1, 1)
    rows = [
        ("1", "load", None, None, None, day, day, day.replace(hour=2, minute=3, second=4), "SUCCEEDED", None, None),
        ("2", "load", None, None, None, day.replace(hour=5), day.replace(hour=5), None, "IN_PROGRESS", None, None),
        ("3", "other", None, None, None, day.replace(hour=4), None, None, "QUEUED", None, None),
        ("4", None, "2", 2, "step", day, day, day.replace(minute=1, second=5), "FAILED", "e", None),
        ("5", None, "2", 1, None, day, day, day.replace(second=9, microsecond=999999), "FAILED", "e", None),
    ]
    return spark.createDataFrame(rows, runs.SCHEMA)


def test_lists_of_runs(spark):
    h = full(spark)
    assert [r.uuid for r in runs.top_level(h).collect()] == ["2", "3", "1"]
    assert [r.uuid for r in runs.runs_of(h, "load").collect()] == ["2", "1"]
    assert values(runs.latest(h), "job_path", "uuid") == [("load", "2"), ("other", "3")]
    assert [r.uuid for r in runs.children(h, "2").collect()] == ["5", "4"]
    assert values(runs.unfinished(h), "uuid") == [("2",), ("3",)]
    assert runs.unknown_status(h).count() == 0
    assert runs.unknown_status(h.withColumn("status", F.lit("DONE"))).count() == 5


def test_hung_runs_are_aborted_and_others_untouched(spark):
    h = full(spark)
    assert values(runs.abort_hung(h, NOW).where("status = 'ABORTED'"), "uuid", "completed") == [("2", NOW), ("3", NOW)]
    assert values(runs.abort_hung(h, NOW).where("uuid IN ('1', '4', '5')")) == values(h.where("uuid IN ('1', '4', '5')"))


def test_durations(spark):
    got = runs.with_duration(full(spark), NOW).orderBy("uuid").collect()
    assert [(r.label, r.duration_seconds, r.duration) for r in got] == [
        ("load", 7384, "2h 03m 04s"), ("load", 68400, "19h 00m 00s"), ("other", 0, "-"), ("step", 65, "1m 05s"),
        ("(unknown)", 9, "9s")]


def test_equal_numbers_keep_their_subtrees_apart(spark, db):
    h = history(spark, [("r", None, 1, "FAILED"), ("a", "r", 1, "FAILED"), ("b", "r", 1, "FAILED"), ("a1", "a", 1, "FAILED"),
                        ("b1", "b", 1, "SUCCEEDED")])
    assert [r.uuid for r in runs.tree(h).orderBy("root_uuid", "path").collect()] == ["r", "a", "a1", "b", "b1"]


@pytest.mark.parametrize("seed", [3])
def test_one_run(spark, db, seed):
    rows = random_forest(120, seed)
    h = history(spark, rows)
    everything = {r.uuid: r for r in runs.tree(h).collect()}
    for root in ("r3", "r0"):
        mine = {u for u, r in everything.items() if root in [p.uuid for p in r.path]}
        assert {r.uuid for r in runs.tree(h, root).collect()} == mine
        progress = runs.progress(h, root).first()
        assert (progress.root_uuid, progress.total) == (root, len(mine) - 1)
        assert {r.uuid for r in runs.leaf_failures(h, root).collect()} <= mine
    assert runs.tree(h, "nobody").count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_one_run_is_what_the_whole_forest_says_of_it(spark, db, seed):
    rows = random_forest(150, seed)
    h = history(spark, rows)
    places = {r.uuid: r for r in runs.tree(h).collect()}
    whole = {r.uuid: r.root_uuid for r in runs.root_of(h).collect()}
    for uuid in ("r7", "r60", "r149"):
        assert values(runs.root_of(h, uuid)) == [(uuid, whole[uuid])]
        mine = {u for u, r in places.items() if uuid in [p.uuid for p in r.path]}
        only = h.where(F.col("uuid").isin(list(mine))).withColumn("parent_execution_uuid", F.when(F.col("uuid") != uuid, F.col("parent_execution_uuid")))
        for question in (runs.tree, runs.progress, runs.leaf_failures, runs.remaining):
            one, every = question(h, uuid), question(only)
            assert values(one, *every.columns) == values(every), question.__name__
    assert runs.root_of(h, "nobody").count() == 0


def test_a_circle_met_from_one_run(spark, db):
    h = history(spark, [("a", "c", 1, "FAILED"), ("b", "a", 1, "FAILED"), ("c", "b", 1, "FAILED"), ("d", "c", 1, "FAILED")])
    for question in (lambda: runs.root_of(h, "d"), lambda: runs.tree(h, "a").count(), lambda: runs.progress(h, "b").count()):
        with pytest.raises(LoadError, match="ancestor"):
            question()
