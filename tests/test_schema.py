import pytest
from pyspark.sql.types import StructType

from conftest import values
from tablehaul.errors import LoadError
from tablehaul.operators import schema as s

OLD = "uuid char(38), name varchar(100), amount decimal(10,2), n int"


def test_lengths_survive_in_the_catalog_and_char_is_not_padded(spark, db):
    table = f"{db}.t"
    s.create_table(spark, table, OLD)
    assert values(s.columns_of(spark, table)) == [(1, "uuid", "varchar(38)"), (2, "name", "varchar(100)"),
                                                  (3, "amount", "decimal(10,2)"), (4, "n", "int")]
    spark.sql(f"INSERT INTO {table} VALUES ('abc', 'x', 1, 1)")
    assert spark.table(table).where("concat('a', 'bc') = uuid").count() == 1


@pytest.mark.parametrize("new, same", [
    ("N INT, name VARCHAR(100), UUID char(38), amount decimal(10,2)", True),
    ("uuid char(38), name varchar(101), amount decimal(10,2), n int", False),
    ("uuid char(38), name varchar(100), amount decimal(10,3), n int", False),
    ("uuid char(38), name varchar(100), amount decimal(10,2)", False),
    (OLD + ", extra string", False),
])
def test_same_schema_ignores_case_and_order_only(new, same):
    assert s.same_schema(StructType.fromDDL(OLD), StructType.fromDDL(new)) is same


def test_schema_diff_names_each_change(spark):
    new = "UUID varchar(38), name varchar(200), amount decimal(10,2), provider string"
    assert values(s.schema_diff(spark, OLD, new)) == [
        ("n", "int", None, "removed"), ("name", "varchar(100)", "varchar(200)", "retyped"),
        ("provider", None, "string", "added")]


def test_actions_on_an_existing_table(spark, db):
    table = f"{db}.t"
    assert s.ensure_table(spark, table, "a int") == "created"
    spark.sql(f"INSERT INTO {table} VALUES (1)")
    assert s.ensure_table(spark, table, "b int") == "kept"
    assert s.ensure_table(spark, table, "A INT", if_exists="DROPIFCHANGED") == "kept"
    assert spark.table(table).count() == 1
    assert s.ensure_table(spark, table, "a int, b varchar(5)", if_exists="dropIfChanged") == "recreated"
    assert spark.table(table).count() == 0
    assert s.ensure_table(spark, table, "a int, b varchar(5)", if_exists="drop") == "recreated"
    with pytest.raises(LoadError):
        s.ensure_table(spark, table, "a int", if_exists="replace")


def test_create_like_and_recreate_when_columns_differ(spark, db):
    first, second = f"{db}.a", f"{db}.b"
    s.create_table(spark, first, OLD)
    s.create_like(spark, second, first)
    assert s.columns_changed(spark, first, second) == 0
    assert s.recreate_if_changed(spark, first, second) is False
    s.ensure_table(spark, second, OLD + ", more int", if_exists="drop")
    assert s.columns_changed(spark, first, second) == 1
    assert s.recreate_if_changed(spark, first, second) is True
    assert s.columns_changed(spark, first, second) == 0


def test_describe_a_query_without_running_it(spark):
    described = s.describe_query(spark, "SELECT 1 AS a, raise_error('not run') AS b")
    assert values(described, "pos", "name") == [(1, "a"), (2, "b")]


def test_drop_is_quiet_when_absent(spark, db):
    s.drop_table(spark, f"{db}.nothing")
    s.create_table(spark, f"{db}.t", "a int")
    s.drop_table(spark, f"{db}.t")
    assert not s.table_exists(spark, f"{db}.t")


def test_partition_column_must_exist(spark, db):
    with pytest.raises(LoadError):
        s.create_table(spark, f"{db}.t", "a int", ["p"])
