import pytest
from pyspark.sql import functions as F

from conftest import plan, values
from tablehaul import (DryRun, LoadError, bulk_import, consolidate, consolidate_partitions, fan_out, load_tables,
                       run_sql_steps, transfer, validate_extract)
from tablehaul.operators.schema import as_schema, table_exists

SCHEMA = "uuid varchar(38), name varchar(100), description varchar(1000)"


@pytest.fixture
def source(spark):
    return spark.range(62).selectExpr("concat('u', id) AS uuid", "concat(if(id < 7, 'Primary ', 'Other '), id) AS name",
                                      "concat('Médicaments ', id) AS description")


def count(spark, table):
    return spark.table(table).count()


def test_load_modes(spark, db, source):
    for expected in (62, 62):
        bulk_import(spark, source, f"{db}.a", schema=SCHEMA)
        assert count(spark, f"{db}.a") == expected
    for expected in (62, 124):
        bulk_import(spark, source, f"{db}.b", schema=SCHEMA, drop_and_recreate=False)
        assert count(spark, f"{db}.b") == expected
    for expected in (62, 62):
        transfer(spark, source.select("description", "uuid", "name"), f"{db}.c", schema=SCHEMA)
        assert count(spark, f"{db}.c") == expected
    assert values(spark.table(f"{db}.c")) == values(source)
    bulk_import(spark, source, f"{db}.a")
    assert count(spark, f"{db}.a") == 124
    with pytest.raises(LoadError):
        bulk_import(spark, source, f"{db}.absent")


def test_bulk_load_maps_by_position(spark, db, source):
    bulk_import(spark, source.toDF("x", "y", "z"), f"{db}.a", schema=SCHEMA)
    assert values(spark.table(f"{db}.a")) == values(source)


def test_gate(spark, db, source):
    bulk_import(spark, source, f"{db}.t", schema=SCHEMA, only_if=spark.sql("SELECT 5 > 3"))
    assert count(spark, f"{db}.t") == 62
    for closed in ("SELECT false", "SELECT 'false'", "SELECT 0", "SELECT null", "SELECT 1 WHERE false"):
        done = bulk_import(spark, source, f"{db}.u", schema=SCHEMA, only_if=spark.sql(closed))
        assert done.first().action == "skipped"
    assert not table_exists(spark, f"{db}.u")
    transfer(spark, source, f"{db}.t", schema=SCHEMA, only_if=spark.sql("SELECT false"))
    assert count(spark, f"{db}.t") == 62


def test_extra_columns(spark, db, source):
    bulk_import(spark, source, f"{db}.t", schema=SCHEMA, extra_columns=[
        ("date_changed", "timestamp", "now()"), ("reason", "varchar(20)", "'nightly'")])
    row = spark.table(f"{db}.t").agg(F.count("date_changed"), F.countDistinct("reason")).first()
    assert tuple(row) == (62, 1)
    assert spark.table(f"{db}.t").columns[-2:] == ["date_changed", "reason"]
    with pytest.raises(LoadError):
        bulk_import(spark, source, f"{db}.t", extra_columns=[("a", "int", "1")])
    with pytest.raises(LoadError):
        bulk_import(spark, source, f"{db}.t", schema=SCHEMA, extra_columns=[("NAME", "int", "1")])


def test_partitions_and_schema_change(spark, db, source):
    schema = SCHEMA + ", partition_num int"
    primary = source.where("name LIKE 'Primary%'")
    bulk_import(spark, primary, f"{db}.t", schema=schema, partition=("partition_num", 1))
    bulk_import(spark, source.limit(4), f"{db}.t", schema=schema, partition=("partition_num", 2))
    assert values(spark.table(f"{db}.t").groupBy("partition_num").count()) == [(1, 7), (2, 4)]
    bulk_import(spark, source.limit(4), f"{db}.t", schema=SCHEMA + ", provider varchar(100), partition_num int",
                partition=("partition_num", 2))
    assert values(spark.table(f"{db}.t").groupBy("partition_num").count()) == [(2, 4)]
    for bad in ({"partition": ("partition_num", 1)}, {"schema": schema, "partition": ("", 1)},
                {"schema": schema, "partition": ("partition_num", None)}, {"schema": schema, "incremental": {}}):
        with pytest.raises(LoadError):
            bulk_import(spark, source, f"{db}.t", **bad)


def test_dry_run_loads_nothing_and_reports(spark, db):
    text = spark.createDataFrame([("1", "short"), ("x", "short"), (None, "far too long"), ("2", "fits     ")],
                                 "k string, name string")
    with pytest.raises(DryRun) as run:
        bulk_import(spark, text, f"{db}.t", schema="k int, name varchar(5)", test_only=True, convert=True)
    assert values(run.value.summary) == [(4, 2, 1, 1)]
    assert [tuple(r.failing_columns) for r in run.value.failing.orderBy("k").collect()] == [("name",), ("k",)]
    assert not table_exists(spark, f"{db}.t")
    summary, failing = validate_extract(text.where("false"), "k int, name varchar(5)")
    assert values(summary) == [(0, 0, 0, 0)] and failing.count() == 0


def test_unreadable_source_fails_before_any_write(spark, db, source):
    bulk_import(spark, source, f"{db}.t", schema=SCHEMA)
    with pytest.raises(Exception):
        bulk_import(spark, spark.read.parquet("/nowhere/at/all"), f"{db}.t", schema=SCHEMA)
    assert count(spark, f"{db}.t") == 62


def test_sql_steps_stop_at_the_first_error_and_name_it(spark, db):
    run_sql_steps(spark, ["CREATE TABLE ${db}.${name} (a INT) USING parquet", "INSERT INTO ${db}.${name} VALUES (1)"],
                  {"db": db, "name": "made"})
    assert count(spark, f"{db}.made") == 1
    with pytest.raises(LoadError, match="Statement 2 of 3 failed: SELEC 1"):
        run_sql_steps(spark, [f"INSERT INTO {db}.made VALUES (2)", "SELEC 1", f"INSERT INTO {db}.made VALUES (3)"])
    assert count(spark, f"{db}.made") == 2


def test_consolidation(spark, db, source):
    def starting(params):
        return source.where(F.col("name").startswith(params["prefix"]))

    rows = consolidate(starting, [{"prefix": "Primary", "site": "A"}, {"prefix": "Other 1", "site": "B"}], ["site"])
    assert values(rows.groupBy("site").count()) == [("A", 7), ("B", 10)]
    sets = [{"prefix": "Primary", "p": 1}, {"prefix": "Other 1", "p": 2}, {"prefix": "none", "p": 3}]
    done = consolidate_partitions(spark, starting, sets, f"{db}.t", "p", schema=SCHEMA + ", p int")
    assert values(done, "partition", "rows_added") == [("p=1", 7), ("p=2", 10), ("p=3", 0)]
    consolidate_partitions(spark, starting, [{"prefix": "none", "p": 1}], f"{db}.t", "p")
    assert values(spark.table(f"{db}.t").groupBy("p").count()) == [(2, 10)]
    with pytest.raises(LoadError):
        consolidate_partitions(spark, starting, [sets[0], sets[0]], f"{db}.t", "p")
    with pytest.raises(LoadError):
        consolidate(starting, [])
    assert "Exchange" not in plan(rows)


def test_fan_out_needs_the_same_columns_from_every_source(spark, source):
    tables = fan_out(["a", "b"], [{"site": 1}, {"site": 2}], lambda table, s: source.limit(3), ["site"])
    assert {name: df.count() for name, df in tables.items()} == {"a": 6, "b": 6}
    uneven = fan_out(["a"], [{"site": 1}], lambda table, s: source)
    assert uneven["a"].columns == source.columns
    with pytest.raises(Exception):
        fan_out(["a"], [{"n": 1}, {"n": 2}], lambda table, s: source if s["n"] == 1 else source.drop("name"))


@pytest.mark.parametrize("at_once", [1, 3])
def test_load_tables(spark, db, source, at_once):
    tables = fan_out(["a", "b", "c"], [{"site": 1}, {"site": 2}], lambda table, s: source.limit(3), ["site"])
    for _ in range(2):
        done = load_tables(spark, tables, db, at_once=at_once)
        assert values(done, "table", "rows_after") == [(f"{db}.{name}", 6) for name in "abc"]
    assert values(spark.table(f"{db}.b").groupBy("site").count()) == [(1, 3), (2, 3)]
    broken = {"a": source, "b": source.withColumn("name", F.raise_error(F.lit("broken source"))), "c": source}
    with pytest.raises(Exception, match="broken source" if at_once == 1 else "1 of 3 tables failed: b"):
        load_tables(spark, broken, db, at_once=at_once)
    assert [count(spark, f"{db}.{name}") for name in "abc"] == [62, 6, 6 if at_once == 1 else 62]


def test_incremental_job_with_extra_columns_and_a_source_of_two_marks(spark, db, source):
    schema = "uuid varchar(38), name varchar(100)"
    changes = spark.sql("""SELECT 'u3' AS uuid, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS at
                           UNION ALL SELECT 'u4', TIMESTAMP_NTZ '2024-01-02 00:00:00'""")

    def rows(previous, new):
        chosen = source if previous is None else source.where("uuid IN ('u3', 'u4')")
        return chosen.select("uuid", F.concat("name", F.lit(" first" if previous is None else " later")).alias("name"))

    extra = [("partition_num", "int", "1"), ("site", "varchar(20)", "concat('site of ', uuid)")]
    for until in (1, 2):
        bulk_import(spark, rows, f"{db}.t", schema=schema, extra_columns=extra, partition=("partition_num", 1),
                    incremental={"changes": changes.where(f"day(at) <= {until}"), "key": "uuid", "changed_at": "at",
                                 "log_table": f"{db}.marks"})
    loaded = spark.table(f"{db}.t")
    assert values(loaded.where("name LIKE '% later'"), "uuid", "site", "partition_num") == [
        ("u3", "site of u3", 1), ("u4", "site of u4", 1)]
    assert loaded.count() == 62 and spark.table(f"{db}.marks").count() == 2
    with pytest.raises(DryRun):
        bulk_import(spark, rows, f"{db}.t", schema=schema, partition=("partition_num", 1), incremental={},
                    test_only=True)
    for more in ({}, {"partition": ("name", "x")}):
        with pytest.raises(LoadError):
            bulk_import(spark, rows, f"{db}.u", schema=schema, **more)


@pytest.mark.parametrize("convert", [False, True])
@pytest.mark.parametrize("rows,kinds", [
    ([("1", "ok"), ("2", "ok")], "k string, name string"), ([("x", "ok")], "k string, name string"), ([(1, "ok")], "k int, name string"),
    ([(2**40, "ok")], "k long, name string"), ([(1, "much too long")], "k int, name string"), ([(True, "ok")], "k boolean, name string"),
    ([("a" * 9, "b" * 9)], "aa string, bb string"), ([(1, 5)], "k int, name int")])
def test_dry_run_and_load_agree(spark, db, convert, rows, kinds):
    """By position, as a load without partition takes its columns."""
    from tablehaul.operators.validate import refused_columns

    extract, schema = spark.createDataFrame(rows, kinds), "k int, name varchar(5)"
    with pytest.raises(DryRun) as run:
        bulk_import(spark, extract, f"{db}.agree", schema=schema, test_only=True, convert=convert)
    fits = run.value.summary.first()["rows_failing"] == 0 and not refused_columns(extract, schema and as_schema(schema), "position", convert)
    try:
        bulk_import(spark, extract, f"{db}.agree", schema=schema, convert=convert)
        loaded = True
    except Exception:
        loaded = False
    assert loaded == fits


# Types and a value of each that is hard to store elsewhere.
KINDS = {"boolean": "true", "tinyint": "7Y", "smallint": "700S", "int": "70000", "bigint": "5000000000L", "float": "CAST(1e30 AS float)", "double": "1e300D",
         "decimal(10,2)": "12345678.25BD", "decimal(38,10)": "CAST(1e20 AS decimal(38,10))", "string": "'abcdef'", "varchar(3)": "'abc'", "binary": "X'61'",
         "date": "DATE'2024-01-02'", "timestamp": "TIMESTAMP_LTZ'2024-01-02 03:04:05'", "timestamp_ntz": "TIMESTAMP_NTZ'2024-01-02 03:04:05'",
         "array<int>": "array(1, 70000)", "array<tinyint>": "array(1Y)", "array<string>": "array('abcdef')", "array<varchar(3)>": "array('abc')",
         "map<string,int>": "map('abcdef', 70000)", "map<varchar(3),tinyint>": "map('abc', 1Y)", "struct<x: int>": "named_struct('x', 70000)",
         "struct<x: varchar(3), y: array<tinyint>>": "named_struct('x', 'abcdef', 'y', array(70000))"}


def test_dry_run_and_load_agree_on_all_pairs_of_types(spark, db):
    from tablehaul import append_by_name
    from tablehaul.operators.validate import refused_columns, validate_extract

    # All targets of one source are judged by one dry run; the loads go one by one.
    for source, value in KINDS.items():
        target = ", ".join(f"c{i} {kind}" for i, kind in enumerate(KINDS))
        rows = spark.sql("SELECT " + ", ".join(f"{value} AS c{i}" for i in range(len(KINDS))))
        refused = {r.split(":")[0] for r in refused_columns(rows, target)}
        failing = set(validate_extract(rows, target, convert=False)[1].select("failing_columns").first()[0] or [])
        assert refused <= failing
        for i, kind in enumerate(KINDS):
            if f"c{i}" in refused:
                continue  # by Spark's own word
            spark.sql(f"CREATE OR REPLACE TEMP VIEW one AS SELECT {value} AS c")
            spark.sql(f"CREATE TABLE {db}.t{i} (c {kind}) USING parquet") if source == "boolean" or not spark.catalog.tableExists(f"{db}.t{i}") else None
            try:
                append_by_name(spark, spark.table("one"), f"{db}.t{i}")
                loaded = True
            except Exception:
                loaded = False
            assert loaded == (f"c{i}" not in failing), (source, kind)


def test_dry_run_tells_what_refuses_a_load(spark, db):
    rows = spark.sql("SELECT 1 AS a, array('x') AS b, 2 AS c")
    with pytest.raises(DryRun) as run:
        transfer(spark, rows, f"{db}.t", schema="a int, b array<int>", test_only=True)
    assert run.value.refused == ["b: array<string> is not stored as array<int>", "c: not in the target"]
    assert run.value.failing.first()["failing_columns"] == ["b"]
    with pytest.raises(LoadError):
        transfer(spark, rows, f"{db}.t", schema="a int, b array<int>")
    with pytest.raises(DryRun) as run:
        transfer(spark, rows.drop("c"), f"{db}.t", schema="a int, b array<int>", test_only=True, convert=True)
    assert run.value.refused == [] and run.value.failing.first()["failing_columns"] == ["b"]
    with pytest.raises(DryRun) as run:
        bulk_import(spark, rows, f"{db}.t", schema="a int, b array<string>", test_only=True)
    assert run.value.refused == ["3 columns for 2"]
