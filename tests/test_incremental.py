from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, values
from tablehaul.errors import LoadError
from tablehaul.operators.schema import table_exists
from tablehaul.streaming import incremental as inc

T1, T2, T3 = datetime(2022, 2, 4, 10, 32, 15), datetime(2022, 2, 5, 9, 54, 9), datetime(2022, 2, 5, 9, 54, 10)


def data(spark, n=62, suffix=""):
    return spark.range(n).selectExpr("concat('u', id) AS uuid", f"concat('name ', id, '{suffix}') AS name")


def log(spark, *entries):
    return spark.createDataFrame([(f"u{k}", t) for k, t in entries], "uuid string, last_updated timestamp_ntz")


class Load:
    def __init__(self, spark, db):
        self.spark, self.target, self.log = spark, f"{db}.types", f"{db}.marks"

    def __call__(self, source, changes, partition=1, **more):
        done = inc.incremental_load(self.spark, source=source, changes=changes, key="uuid", changed_at="last_updated",
                                    target=self.target, partition=("partition_num", partition), log_table=self.log,
                                    mark="message", **more)
        return done.first()

    def messages(self):
        return values(self.spark.table(self.target).groupBy("message").count())

    def marks(self):
        return values(self.spark.table(self.log), "starting_watermark", "ending_watermark")


@pytest.fixture
def load(spark, db):
    return Load(spark, db)


def test_initial_then_changed_rows_on_both_ends_of_the_window(spark, load):
    """One key moved onto the old mark, one already on it, one a second later."""
    changes = log(spark, (1, T1), (2, datetime(2022, 2, 4, 22, 11, 19)), (3, T2))
    assert load(data(spark), changes).action == "initial-load"
    assert load.messages() == [("initial-load", 62)]
    assert load.marks() == [(None, T2)]

    changes = log(spark, (1, T2), (2, datetime(2022, 2, 4, 22, 11, 19)), (3, T2), (4, T3))
    done = load(data(spark, suffix=" new"), changes)
    assert (done.action, done.rows_before, done.rows_removed, done.rows_added, done.rows_after) == (
        "incremental-load", 62, 3, 3, 62)
    assert load.messages() == [("incremental-load", 3), ("initial-load", 59)]
    assert values(spark.table(load.target).where("name LIKE '% new'"), "uuid") == [("u1",), ("u3",), ("u4",)]
    assert load.marks() == [(None, T2), (T2, T3)]


def test_equal_marks_do_nothing(spark, load):
    load(data(spark), log(spark, (1, T1)))
    assert load(data(spark, 5), log(spark, (1, T1))).action == "skipped"
    assert load.messages() == [("initial-load", 62)] and len(load.marks()) == 1


def test_no_marks_at_all_loads_in_full_every_time_and_logs_nothing(spark, load):
    for n in (10, 7):
        assert load(data(spark, n), log(spark)).action == "initial-load"
        assert load.messages() == [("initial-load", n)]
    assert not table_exists(spark, load.log)


def test_lost_new_mark_keeps_the_partition(spark, load):
    load(data(spark), log(spark, (1, T1)))
    load(data(spark, 3), log(spark))
    assert load.messages() == [("initial-load", 62)] and load.marks() == [(None, T1)]


def test_mark_that_went_back_changes_no_rows_and_the_highest_mark_counts(spark, load):
    load(data(spark), log(spark, (1, T2)))
    load(data(spark, 3), log(spark, (1, T1)))
    assert load.messages() == [("initial-load", 62)]
    assert load.marks() == [(None, T2), (T2, T1)]
    assert inc.previous_watermark(spark, load.log, load.target, 1) == T2


def test_row_gone_from_the_source_disappears_only_when_logged(spark, load):
    load(data(spark), log(spark, (1, T1)))
    shrunk = data(spark).where("uuid NOT IN ('u5', 'u6')")
    load(shrunk, log(spark, (1, T1), (5, T2)))
    left = {r.uuid for r in spark.table(load.target).collect()}
    assert "u5" not in left and "u6" in left and len(left) == 61


def test_repeated_log_entries_repeat_rows_only_when_asked(spark, load):
    changes = log(spark, (1, T2), (1, T3), (2, T3))
    load(data(spark), log(spark, (9, T1)))
    load(data(spark), changes)
    assert load.messages() == [("incremental-load", 2), ("initial-load", 60)]
    load(data(spark), log(spark, (1, T3), (1, datetime(2022, 3, 1)), (2, T3)), dedup=False)
    assert load.messages() == [("incremental-load", 3), ("initial-load", 60)]


def test_partitions_have_marks_of_their_own(spark, load):
    load(data(spark, 10), log(spark, (1, T1)), 1)
    load(data(spark, 20), log(spark, (1, T2)), 2)
    assert load(data(spark, 10), log(spark, (1, T1)), 1).action == "skipped"
    assert values(spark.table(load.target).groupBy("partition_num").count()) == [(1, 10), (2, 20)]


def test_changed_columns_force_a_full_load_of_every_partition(spark, load):
    load(data(spark, 10), log(spark, (1, T1)), 1)
    load(data(spark, 20), log(spark, (1, T1)), 2)
    wider = data(spark, 20).withColumn("more", F.lit(1))
    assert load(wider, log(spark, (1, T1), (2, T2)), 2).action == "initial-load"
    assert values(spark.table(load.target).groupBy("partition_num").count()) == [(2, 20)]
    # The other partition went with the old columns: its recorded mark must not hide that.
    assert load(data(spark, 10).withColumn("more", F.lit(1)), log(spark, (1, T1)), 1).action == "initial-load"
    assert values(spark.table(load.target).groupBy("partition_num").count()) == [(1, 10), (2, 20)]
    with pytest.raises(LoadError):
        load(data(spark, 10), log(spark, (1, T3)), 1, on_schema_change="fail")


def test_source_as_a_function_of_the_marks(spark, load):
    seen = []

    def source(previous, new):
        seen.append((previous, new))
        return data(spark) if previous is None else data(spark).where("uuid = 'u3'")

    load(source, log(spark, (3, T1)))
    load(source, log(spark, (3, T2)))
    assert seen == [(None, T1), (T1, T2)]
    assert load.messages() == [("incremental-load", 1), ("initial-load", 61)]


def test_failed_refresh_leaves_rows_and_marks(spark, load):
    load(data(spark), log(spark, (1, T1)))
    broken = data(spark).withColumn("name", F.when(F.col("uuid") == "u1", F.raise_error(F.lit("broken source")))
                                    .otherwise(F.col("name")))
    with pytest.raises(Exception, match="broken source"):
        load(broken, log(spark, (1, T2)))
    assert load.messages() == [("initial-load", 62)] and load.marks() == [(None, T1)]


def test_null_keys_are_kept(spark, load):
    rows = data(spark, 3).unionByName(spark.sql("SELECT string(null) AS uuid, 'nameless' AS name"))
    load(rows, log(spark, (1, T1)))
    load(rows, log(spark, (1, T2)))
    assert load.messages() == [("incremental-load", 1), ("initial-load", 3)]


def test_bad_definitions(spark, load, db):
    good = dict(source=data(spark), changes=log(spark, (1, T1)), key="uuid", changed_at="last_updated",
                target=load.target, partition=("partition_num", 1), log_table=load.log)
    for bad in ({"partition": ("", 1)}, {"partition": ("p", None)}, {"log_table": ""}, {"key": []},
                {"changed_at": ""}, {"on_schema_change": "ignore"}):
        with pytest.raises(LoadError):
            inc.incremental_load(spark, **{**good, **bad})
    spark.sql(f"CREATE TABLE {db}.odd (a int) USING parquet")
    with pytest.raises(Exception):
        inc.incremental_load(spark, **{**good, "log_table": f"{db}.odd"})
    assert not table_exists(spark, load.target)


def test_a_small_change_set_never_shuffles_the_source(spark):
    changes = log(spark, *[(i % 4, T2) for i in range(1000)])
    rows = inc.delta(data(spark, 1000), changes, ["uuid"], "last_updated", T1, T3)
    assert "BroadcastHashJoin" in plan(rows) and "Exchange hashpartitioning" not in plan(rows)
    assert rows.count() == 4


def test_the_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, (1, T1), (2, T2)).write.parquet(path)
    kept = inc.in_window(spark.read.parquet(path), "last_updated", T1, T1)
    assert "PushedFilters: [IsNotNull(last_updated), GreaterThanOrEqual(last_updated" in plan(kept)
    assert kept.count() == 1


@pytest.fixture(params=["shuffled", "broadcast"])
def joins(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_key_with_a_third_of_the_rows(spark, db, joins):
    """A hot key in the data and in the log, with and without a broadcast, against plain counting."""
    rows = [(f"u{0 if i % 3 == 0 else i}", f"row {i}") for i in range(3000)]
    entries = [(0, T2)] * 300 + [(i, T2) for i in range(1, 3000, 7)] + [(2, T1), (9999, T2)]
    source = spark.createDataFrame(rows, "uuid string, name string")
    load = Load(spark, db)
    load(source, log(spark, (2, T1)))
    done = load(source.withColumn("name", F.concat("name", F.lit(" new"))), log(spark, *entries))
    changed = {f"u{k}" for k, t in entries}
    moved = sum(key in changed for key, _ in rows)
    assert (done.rows_before, done.rows_removed, done.rows_added, done.rows_after) == (3000, moved, moved, 3000)
    want = sorted((key, name + " new" if key in changed else name) for key, name in rows)
    assert values(spark.table(load.target), "uuid", "name") == sorted(want)


def test_several_key_columns(spark, db):
    source = spark.range(20).selectExpr("id % 4 AS a", "string(id) AS b", "'old' AS v")
    changes = spark.createDataFrame([(1, "5", T1), (1, "6", T2)], "a bigint, b string, at timestamp_ntz")
    args = dict(key=["a", "b"], changed_at="at", target=f"{db}.t", partition=("site", "north"), log_table=f"{db}.l")
    inc.incremental_load(spark, source=source, changes=changes.where("b = '5'"), **args)
    inc.incremental_load(spark, source=source.withColumn("v", F.lit("new")), changes=changes, **args)
    assert values(spark.table(f"{db}.t").where("v = 'new'")) == [(1, "5", "new", "north")]
    assert values(spark.table(f"{db}.l"), "partition_num") == [("north",), ("north",)]


def test_the_range_of_changed_keys_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(100).selectExpr("int(id) AS k", "string(id) AS name").write.parquet(path)
    source = spark.read.parquet(path)
    changed, seen = inc._key_range(spark.sql("SELECT explode(array(7L, 90L, null)) AS k"), ["k"])
    changed.collect()
    narrow = inc._in_range(source, "k", seen)
    assert "GreaterThanOrEqual(k,7), LessThanOrEqual(k,90)" in plan(narrow) and narrow.count() == 84
    text_keys, seen = inc._key_range(spark.sql("SELECT 'a' AS k"), ["k"])
    assert seen is None and inc._in_range(source, "k", seen) is source
    changed, seen = inc._key_range(spark.sql("SELECT 5L AS k"), ["k"])
    changed.collect()
    as_text = source.withColumn("k", F.col("k").cast("string"))
    assert inc._in_range(as_text, "k", seen) is as_text


@pytest.mark.parametrize("dedup", [True, False])
def test_whole_number_keys(spark, db, dedup):
    source = spark.range(50).selectExpr("if(id % 3 = 0, 0, int(id)) AS k", "id AS v")
    changes = spark.createDataFrame([(0, T1), (0, T2), (0, T2), (40, T2), (999, T3), (None, T3)],
                                    "k bigint, at timestamp_ntz")
    args = dict(key="k", changed_at="at", target=f"{db}.t", partition=("p", 1), log_table=f"{db}.l", mark="m")
    inc.incremental_load(spark, source=source, changes=changes.where("at <= '2022-02-04 12:00:00'"), **args)
    done = inc.incremental_load(spark, source=source, changes=changes, dedup=dedup, **args).first()
    hot = source.where("k = 0").count()
    repeats = 1 if dedup else 3
    assert (done.rows_removed, done.rows_added) == (hot + 1, hot * repeats + 1)
    assert spark.table(f"{db}.t").where("m = 'incremental-load'").count() == hot * repeats + 1


def test_loads_in_threads_do_not_meet(spark, db):
    """Eight refreshes of eight tables at once; each keeps its own intermediate files and records its own mark."""
    from concurrent.futures import ThreadPoolExecutor

    from tablehaul.streaming import incremental_load, previous_watermark

    rows = spark.range(200).selectExpr("id", "cast(id as string) as name")
    first = spark.createDataFrame([(i, datetime(2024, 1, 1) if i == 0 else datetime(2023, 12, 1)) for i in range(200)],
                                  "id long, ts timestamp_ntz")
    later = first.unionByName(spark.createDataFrame([(i, datetime(2024, 1, 2)) for i in range(0, 200, 3)],
                                                    "id long, ts timestamp_ntz"))

    def load(number):
        options = {"key": "id", "changed_at": "ts", "target": f"{db}.t{number}", "partition": ("part", 1),
                   "log_table": f"{db}.log{number}"}
        incremental_load(spark, source=rows, changes=first, **options)
        incremental_load(spark, source=rows.withColumn("name", F.lit(f"new {number}")), changes=later, **options)
        return previous_watermark(spark, f"{db}.log{number}", f"{db}.t{number}", 1)

    with ThreadPoolExecutor(8) as pool:
        marks = list(pool.map(load, range(8)))
    assert marks == [datetime(2024, 1, 2)] * 8
    for number in range(8):
        names = [r["name"] for r in spark.table(f"{db}.t{number}").collect()]
        assert len(names) == 200 and names.count(f"new {number}") == 67


def test_many_partitions_report_and_skip(spark, db):
    from tablehaul.streaming import incremental_load_partitions

    rows = spark.range(60).selectExpr("id", "cast(id % 4 as int) as part")
    changes = spark.createDataFrame([(i, i % 4, datetime(2024, 1, 1)) for i in range(60)], "id long, part int, ts timestamp_ntz")
    options = {"key": "id", "changed_at": "ts", "target": f"{db}.many", "column": "part", "values": [0, 1, "2", 3], "log_table": f"{db}.marks"}
    done = incremental_load_partitions(spark, source=rows, changes=changes, **options)
    assert {r["partition"]: (r["action"], r["rows_after"]) for r in done.collect()} == {f"part={p}": ("initial-load", 15) for p in range(4)}
    done = incremental_load_partitions(spark, source=rows, changes=changes, **options)
    assert {r["action"] for r in done.collect()} == {"skipped"}
    more = changes.unionByName(spark.createDataFrame([(1, 1, datetime(2024, 1, 5))], "id long, part int, ts timestamp_ntz"))
    done = incremental_load_partitions(spark, source=rows.where("id <> 1"), changes=more, **options)
    assert {r["partition"]: r["action"] for r in done.collect()} == {"part=0": "skipped", "part=1": "incremental-load", "part=2": "skipped",
                                                                     "part=3": "skipped"}
    assert spark.table(f"{db}.many").count() == 59


def test_bloom_filter_keeps_other_rows_out_of_the_join(spark, db):
    from tablehaul.streaming.bloom import bloom_filter, might_hold
    from tablehaul.streaming.incremental import _Narrowed

    rows = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("code"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "code string, id long"))
    changed = rows.where("id % 100 = 3").select("code")
    bloom, bits = bloom_filter(changed, 600)
    assert bits == 8192 and rows.where("id % 100 = 3").where(might_hold(bloom, bits, [F.col("code")])).count() == 600
    assert rows.where(might_hold(bloom, bits, [F.col("code")])).count() < 3000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bloom_from, least, most in ((1, 600, 3000), (10**9, 60_000, 60_001)):
            narrowed = _Narrowed(changed, ["code"], False, 600, bloom_from)
            mine, others = narrowed.matching(rows, "left_semi"), narrowed.others(rows)
            assert {r.id for r in mine.collect()} == set(range(3, 60_000, 100))
            assert others.count() == 60_001 - 600 and others.where("id = -1").count() == 1
            assert least <= _shuffled(mine) <= most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _shuffled(df):
    """Rows that the larger side of the join sent through its shuffle."""
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], [0]
    while nodes:
        node = nodes.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return max(found)


@pytest.mark.parametrize("ignore_case", [False, True])
def test_a_bloom_filter_changes_no_result(spark, db, ignore_case):
    rows = spark.createDataFrame([(f"K{i}", i) for i in range(200)], "code string, n int")
    changes = spark.createDataFrame([(f"K{i}" if i % 2 or not ignore_case else f"k{i}", datetime(2024, 1, 1 + i % 3)) for i in range(0, 150, 7)], "code string, at timestamp_ntz")
    got = []
    for name, bloom_from in (("a", 1), ("b", 10**9)):
        options = {"key": "code", "changed_at": "at", "target": f"{db}.{name}", "partition": ("p", 1), "log_table": f"{db}.{name}_log",
                   "ignore_case": ignore_case, "bloom_from": bloom_from, "mark": "how"}
        inc.incremental_load(spark, source=rows, changes=changes.where("at < TIMESTAMP_NTZ'2024-01-02'"), **options)
        inc.incremental_load(spark, source=rows.where("n % 21 <> 0").withColumn("n", F.col("n") + 1000), changes=changes, **options)
        got.append(values(spark.table(f"{db}.{name}")))
    assert got[0] == got[1] and 150 < len(got[0]) < 200


def test_many_partitions_from_a_function_of_their_marks(spark, db):
    from tablehaul import incremental_load_partitions
    from tablehaul.streaming import partition_predicates

    rows = spark.range(40).selectExpr("concat('K', id) AS code", "id AS n", "concat('p', id % 4) AS part")
    changes = rows.selectExpr("lower(code) AS code", "part", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(int(n)) AS at", "n AS value").where("part <> 'p3'")
    asked = []

    def source(data):
        def choose(marks):
            asked.append(partition_predicates(marks, "part", "at between '{previous}' and '{new}'"))
            return data.where(F.col("part").isin([m["value"] for m in marks.collect()]))
        return choose

    options = {"key": "code", "changed_at": "at", "target": f"{db}.t", "column": "part", "values": ["p0", "p1", "p2", "p3"], "log_table": f"{db}.log",
               "mark": "how", "ignore_case": True}
    schema = "code string, n bigint, how string, part string"
    with pytest.raises(LoadError, match="schema"):
        incremental_load_partitions(spark, source=source(rows), changes=changes, **options)
    first = incremental_load_partitions(spark, source=source(rows), changes=changes.where("value < 20"), schema=schema, **options)
    assert values(first, "partition", "action") == [(f"part=p{i}", "initial-load") for i in range(4)]
    assert asked[0] == [f"part = 'p{i}'" for i in range(4)]
    # Only changed rows are asked for and returned; p3 has no mark at all and is loaded in full.
    later = rows.withColumn("n", F.col("n") + 100).where("n >= 116 OR part = 'p3'")
    done = incremental_load_partitions(spark, source=source(later), changes=changes, schema=schema, **options)
    assert {r.partition: r.action for r in done.collect()} == {"part=p0": "incremental-load", "part=p1": "incremental-load", "part=p2": "incremental-load",
                                                              "part=p3": "initial-load"}
    assert asked[1][0] == "part = 'p0' AND (at between '2024-01-17 00:00:00' and '2024-02-06 00:00:00')" and asked[1][3] == "part = 'p3'"
    got = {r.code: (r.n, r.how) for r in spark.table(f"{db}.t").collect()}
    assert len(got) == 40 and got["K16"] == (116, "incremental-load") and got["K12"] == (12, "initial-load") and got["K3"] == (103, "initial-load")
    with pytest.raises(LoadError, match="differ"):
        incremental_load_partitions(spark, source=source(later), changes=changes, schema=schema + ", more int", on_schema_change="fail", **options)
