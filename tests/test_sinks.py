import pytest
from pyspark.sql import functions as F

from conftest import plan, values
from tablehaul.errors import LoadError
from tablehaul.operators import sinks
from tablehaul.operators.schema import create_table, location_of, table_exists
from tablehaul.workspace import child_dirs

SCHEMA = "k int, name varchar(5), p int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), "k int, name string")


def one(audit):
    return audit.first().asDict()


def test_replace_is_idempotent_and_removes_the_old_files(spark, db):
    table = f"{db}.t"
    for _ in range(3):
        done = one(sinks.replace_table(spark, rows(spark, (1, "a"), (2, "b")), table, "k int, name string"))
    assert done["rows_added"] == done["rows_after"] == 2
    assert values(spark.table(table)) == [(1, "a"), (2, "b")]
    base = location_of(spark, table).rsplit("/", 1)[0]
    assert len(child_dirs(spark, base)) == 1


def test_replace_may_read_its_own_target_and_change_its_columns(spark, db):
    table = f"{db}.t"
    sinks.replace_table(spark, rows(spark, (1, "a"), (2, "b")), table, "k int, name string")
    sinks.replace_table(spark, spark.table(table).where("k = 2"), table)
    assert values(spark.table(table)) == [(2, "b")]
    sinks.replace_table(spark, spark.table(table).withColumn("more", F.lit(1)), table, "name string, k int, more int")
    assert spark.table(table).columns == ["name", "k", "more"]
    assert values(spark.table(table)) == [("b", 2, 1)]


def test_failed_replace_leaves_the_target_alone(spark, db):
    table = f"{db}.t"
    sinks.replace_table(spark, rows(spark, (1, "a")), table, "k int, name varchar(5)")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        sinks.replace_table(spark, rows(spark, (1, "much too long")), table, "k int, name varchar(5)")
    with pytest.raises(Exception, match="broken source"):
        broken = rows(spark, (1, "a")).withColumn("name", F.raise_error(F.lit("broken source")))
        sinks.replace_table(spark, broken, table)
    assert values(spark.table(table)) == [(1, "a")]
    assert not [t.name for t in spark.catalog.listTables(db) if "stage" in t.name]


def test_append_by_position_and_by_name(spark, db):
    table = f"{db}.t"
    create_table(spark, table, "a int, b string, c int")
    data = spark.sql("SELECT 1 AS c, 'x' AS b, 2 AS a")
    assert one(sinks.append_by_position(spark, data, table))["rows_added"] == 1
    sinks.append_by_name(spark, data, table)
    sinks.append_by_name(spark, spark.sql("SELECT 'only' AS B"), table)
    assert values(spark.table(table)) == [(None, "only", None), (1, "x", 2), (2, "x", 1)]
    with pytest.raises(LoadError):
        sinks.append_by_name(spark, spark.sql("SELECT 1 AS other"), table)
    with pytest.raises(LoadError):
        sinks.append_by_position(spark, data, f"{db}.absent")


def test_partition_replace_empties_on_an_empty_extract(spark, db):
    table = f"{db}.t"
    sinks.replace_partition(spark, rows(spark, (1, "a"), (2, "b")), table, "p", 1, schema=SCHEMA)
    sinks.replace_partition(spark, rows(spark, (3, "c")), table, "p", 2)
    done = one(sinks.replace_partition(spark, rows(spark), table, "p", 1))
    assert (done["rows_before"], done["rows_removed"], done["rows_added"], done["rows_after"]) == (2, 2, 0, 0)
    assert values(spark.table(table)) == [(3, "c", 2)]
    assert sinks.partition_exists(spark, table, "p", 1) and not sinks.partition_exists(spark, table, "p", 9)


def test_partition_replace_may_read_its_own_partition(spark, db):
    table = f"{db}.t"
    sinks.replace_partition(spark, rows(spark, (1, "a"), (2, "b")), table, "p", 1, schema=SCHEMA)
    current = spark.table(table).where("p = 1")
    sinks.replace_partition(spark, current.where("k = 2"), table, "p", 1)
    assert values(spark.table(table)) == [(2, "b", 1)]


def test_partition_replace_refuses_rows_of_another_partition(spark, db):
    table = f"{db}.t"
    sinks.replace_partition(spark, rows(spark, (1, "a")), table, "p", 1, schema=SCHEMA)
    with pytest.raises(Exception, match="Row outside partition"):
        sinks.replace_partition(spark, rows(spark, (5, "z")).withColumn("p", F.lit(2)), table, "p", 1)
    with pytest.raises(LoadError, match="outside the listed"):
        sinks.replace_partitions(spark, rows(spark, (5, "z")).withColumn("p", F.lit(2)), table, "p", [1])
    assert values(spark.table(table)) == [(1, "a", 1)]


def test_added_column_is_matched_by_name_not_position(spark, db):
    table = f"{db}.t"
    sinks.replace_partition(spark, rows(spark, (1, "a")), table, "p", 1, schema=SCHEMA)
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (extra string)")
    shuffled = spark.sql("SELECT 7 AS p, 'e' AS extra, 'n' AS name, 2 AS k")
    sinks.append_by_name(spark, shuffled, table)
    assert values(spark.table(table), "k", "name", "extra", "p") == [(1, "a", None, 1), (2, "n", "e", 7)]


def test_schema_change_recreates_the_whole_target(spark, db):
    table = f"{db}.t"
    sinks.replace_partition(spark, rows(spark, (1, "a"), (2, "b")), table, "p", 1, schema=SCHEMA)
    sinks.replace_partition(spark, rows(spark, (3, "c")), table, "p", 2, schema="k int, name varchar(9), p int")
    assert values(spark.table(table)) == [(3, "c", 2)]
    sinks.replace_partitions(spark, spark.sql("SELECT 4 AS k, 'd' AS name, 5 AS more, 3 AS p"), table, "p", [3, 4],
                             schema="k int, name varchar(9), more int, p int")
    assert values(spark.table(table)) == [(4, "d", 5, 3)]


def test_several_partitions_at_once(spark, db):
    table = f"{db}.t"
    data = spark.range(90).selectExpr("int(id) AS k", "string(id) AS name", "int(id % 3) AS p")
    sinks.replace_partitions(spark, data, table, "p", [0, 1, 2], schema=SCHEMA)
    done = sinks.replace_partitions(spark, data.where("p = 1 AND k < 10"), table, "p", [1, 2, 8], rebalance=False)
    assert values(done, "partition", "rows_before", "rows_removed", "rows_added", "rows_after") == [
        ("p=1", 30, 30, 3, 3), ("p=2", 30, 30, 0, 0), ("p=8", 0, 0, 0, 0)]
    assert values(spark.table(table).groupBy("p").count()) == [(0, 30), (1, 3)]


def test_partition_values_with_special_characters(spark, db):
    table = f"{db}.t"
    names = ["a/b", "it's", "x=y z", "100%"]
    data = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "k int, site string")
    sinks.replace_partitions(spark, data, table, "site", names, schema="k int, site string")
    assert values(spark.table(table)) == sorted((i, n) for i, n in enumerate(names))
    sinks.replace_partition(spark, spark.sql("SELECT 9 AS k"), table, "site", "it's")
    sinks.replace_partition(spark, spark.sql("SELECT 8 AS k"), table, "site", "a/b")
    assert values(spark.table(table)) == [(2, "x=y z"), (3, "100%"), (8, "a/b"), (9, "it's")]


def test_partitioned_full_replace(spark, db):
    table = f"{db}.t"
    data = spark.range(30).selectExpr("int(id) AS k", "string(id) AS name", "int(id % 3) AS p")
    sinks.replace_table(spark, data, table, SCHEMA, partition_by=["p"])
    sinks.replace_table(spark, data.where("p <> 1"), table)
    assert values(spark.table(table).groupBy("p").count()) == [(0, 10), (2, 10)]
    sinks.append_by_name(spark, data.where("p = 1"), table)
    assert values(spark.table(table).groupBy("p").count()) == [(0, 10), (1, 10), (2, 10)]


def test_bad_partition_arguments(spark, db):
    with pytest.raises(LoadError):
        sinks.replace_partition(spark, rows(spark), f"{db}.t", "p", 1)
    with pytest.raises(LoadError):
        sinks.replace_partition(spark, rows(spark), f"{db}.t", "p", None, schema=SCHEMA)
    with pytest.raises(LoadError):
        sinks.replace_partition(spark, rows(spark), f"{db}.t", "q", 1, schema=SCHEMA)
    create_table(spark, f"{db}.flat", SCHEMA)
    with pytest.raises(LoadError):
        sinks.replace_partition(spark, rows(spark), f"{db}.flat", "p", 1)
    assert not table_exists(spark, f"{db}.t")


def test_one_key_with_a_third_of_the_rows_is_written_whole(spark, db):
    table = f"{db}.t"
    data = spark.range(30000).selectExpr("int(id) AS k", "'x' AS name", "int(if(id % 3 = 0, 0, id % 50)) AS p")
    sinks.replace_partitions(spark, data, table, "p", range(50), schema=SCHEMA)
    assert values(spark.table(table).groupBy("p").count()) == values(data.groupBy("p").count())


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_tables_made_by_plain_sql(spark, db, kind):
    """Managed tables keep their format, and their own folder is not where new versions are staged."""
    spark.sql(f"CREATE TABLE {db}.flat USING {kind} AS SELECT 1 AS k, 'a' AS name")
    old = location_of(spark, f"{db}.flat")
    sinks.replace_table(spark, rows(spark, (2, "b")), f"{db}.flat")
    assert values(spark.table(f"{db}.flat")) == [(2, "b")]
    assert location_of(spark, f"{db}.flat") != old
    sinks.replace_table(spark, rows(spark, (3, "c")).withColumn("more", F.lit(1)), f"{db}.flat",
                        "k int, name string, more int")
    assert values(spark.table(f"{db}.flat")) == [(3, "c", 1)]

    spark.sql(f"CREATE TABLE {db}.parts USING {kind} PARTITIONED BY (p) AS SELECT 1 AS k, 'a' AS name, 1 AS p")
    spark.sql(f"INSERT INTO {db}.parts VALUES (2, 'b', 2)")
    sinks.replace_partition(spark, rows(spark, (5, "e")), f"{db}.parts", "p", 1)
    sinks.replace_partitions(spark, rows(spark, (6, "f")).withColumn("p", F.lit(3)), f"{db}.parts", "p", [3])
    assert values(spark.table(f"{db}.parts")) == [(2, "b", 2), (5, "e", 1), (6, "f", 3)]
    sinks.replace_partition(spark, rows(spark, (7, "g")), f"{db}.parts", "p", 1, schema="k bigint, name string, p int")
    assert values(spark.table(f"{db}.parts")) == [(7, "g", 1)]


def test_other_formats_are_refused(spark, db):
    spark.sql(f"CREATE TABLE {db}.t USING json AS SELECT 1 AS k")
    with pytest.raises(LoadError, match="json"):
        sinks.replace_table(spark, spark.sql("SELECT 2 AS k"), f"{db}.t")
    assert values(spark.table(f"{db}.t")) == [(1,)]


def test_a_view_of_the_same_name_is_not_the_table(spark, db):
    spark.sql(f"USE {db}")
    try:
        spark.sql("CREATE OR REPLACE TEMPORARY VIEW same AS SELECT 0 AS k, 'view' AS name")
        assert not table_exists(spark, "same")
        sinks.replace_table(spark, rows(spark, (1, "a")), "same", "k int, name string")
        sinks.append_by_name(spark, rows(spark, (2, "b")), "same")
        assert values(spark.table(f"{db}.same")) == [(1, "a"), (2, "b")]
    finally:
        spark.catalog.dropTempView("same")
        spark.sql("USE default")


def test_reading_one_partition_reads_only_its_files(spark, db):
    table = f"{db}.t"
    data = spark.range(90).selectExpr("int(id) AS k", "string(id) AS name", "int(id % 3) AS p")
    sinks.replace_partitions(spark, data, table, "p", [0, 1, 2], schema=SCHEMA)
    one_partition = spark.table(table).where("p = 1").select("k")
    text = plan(one_partition)
    assert "PartitionFilters: [isnotnull(p" in text and "ReadSchema: struct<k:int>" in text
    assert len(one_partition.inputFiles()) < len(spark.table(table).inputFiles())


@pytest.mark.parametrize("managed", [False, True])
def test_a_table_below_anothers_location_survives(spark, db, tmp_path, managed):
    outer = f"{db}.outer_one"
    spark.sql(f"CREATE TABLE {outer} (id INT) USING parquet" + ("" if managed else f" LOCATION '{tmp_path}/ext'"))
    where = spark.sql(f"DESCRIBE EXTENDED {outer}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"CREATE TABLE {db}.inner_one (id INT) USING parquet LOCATION '{where}/inner'")
    spark.sql(f"INSERT INTO {outer} VALUES (1)")
    spark.sql(f"INSERT INTO {db}.inner_one VALUES (2)")
    sinks.replace_table(spark, spark.createDataFrame([(3,)], "id int"), outer)
    assert values(spark.table(outer)) == [(3,)] and values(spark.table(f"{db}.inner_one")) == [(2,)]


def test_partition_values_given_as_text(spark, db):
    rows = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "id int, part int")
    done = sinks.replace_partitions(spark, rows, f"{db}.texts", "part", ["07", "8"], schema="id int, part int")
    assert values(done, "partition", "rows_after") == [("part=7", 2), ("part=8", 1)]
