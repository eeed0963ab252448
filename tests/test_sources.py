from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from tablehaul import LoadError, Ranges, extract, gate, jdbc_options, read_jdbc, read_table, scalar, staged_extract, write_jdbc
from tablehaul.operators.schema import table_exists
from tablehaul.sources import run_context, scalar_timestamp, substitute


def test_connection_options():
    mysql = jdbc_options("mysql", "host", 3306, "db", "me", "secret")
    assert mysql["url"].startswith("jdbc:mysql://host:3306/db?autoReconnect=true&")
    assert (mysql["user"], mysql["password"], mysql["driver"]) == ("me", "secret", "com.mysql.cj.jdbc.Driver")
    assert jdbc_options("MySQL", "h", 1, "d", options="a=b")["url"] == "jdbc:mysql://h:1/d?a=b"
    assert jdbc_options("sqlserver", "h", 1433, "d", options="encrypt=false")["url"] == \
        "jdbc:sqlserver://h:1433;database=d;encrypt=false"
    assert jdbc_options("h2", database="mem:x")["url"] == "jdbc:h2:mem:x"
    assert jdbc_options("mysql", "h", 1, "d", url="jdbc:postgresql://p/db")["url"] == "jdbc:postgresql://p/db"
    assert "password" not in jdbc_options("h2", database="x")
    with pytest.raises(LoadError):
        jdbc_options("oracle", "h", 1, "d")


class Recorder:
    """Stands in for a session or a frame and remembers the options of the last read or write."""

    def __init__(self, bounds=None):
        self.read = self.write = self
        self.seen, self.bounds, self.calls = {}, bounds, []

    def format(self, name):
        self.seen = {"format": name}
        return self

    def options(self, **more):
        self.seen.update(more)
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def mode(self, mode):
        return self.option("mode", mode)

    def coalesce(self, n):
        self.calls.append(("coalesce", n))
        return self

    def load(self):
        self.calls.append(dict(self.seen))
        return self

    save = load

    def first(self):
        return self.bounds

    def jdbc(self, url, table, **more):
        self.seen = {"url": url, "dbtable": table, **more}
        return self


def test_one_connection_streams_from_mysql():
    spark = Recorder()
    read_jdbc(spark, jdbc_options("mysql", "h", 1, "d"), "select 1;", context="set @a = 1", single=True)
    assert spark.seen["dbtable"] == "(select 1) extract_rows"
    assert spark.seen["fetchsize"] == "-2147483648" and spark.seen["sessionInitStatement"] == "set @a = 1"
    assert spark.seen["preferTimestampNTZ"] == "true"


def test_split_reads():
    source = jdbc_options("sqlserver", "h", 1, "d")
    spark = Recorder(bounds=(5, 95))
    read_jdbc(spark, source, "select * from t", fetch_size=500, ranges=Ranges("id", 8))
    assert "min(id)" in spark.calls[0]["dbtable"]
    assert [spark.seen[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "fetchsize")] == \
        ["id", "5", "95", "8", "500"]
    read_jdbc(Recorder(bounds=(None, None)), source, "select * from empty", ranges=Ranges("id", 8))
    spark = Recorder()
    read_jdbc(spark, source, "select * from t", predicates=["id = 7", "id <> 7", "id is null"])
    assert spark.seen["predicates"] == ["id = 7", "id <> 7", "id is null"]
    with pytest.raises(LoadError):
        read_jdbc(spark, source, "select 1", ranges=Ranges("id", 2), predicates=["true"])
    with pytest.raises(LoadError):
        read_jdbc(spark, source, "select 1")


def test_write_options():
    frame = Recorder()
    write_jdbc(frame, jdbc_options("h2", database="x"), "t", mode="overwrite", truncate=True, max_connections=4)
    assert [frame.seen[k] for k in ("dbtable", "batchsize", "queryTimeout", "truncate", "mode")] == \
        ["t", 1000, 7200, "true", "overwrite"]
    assert frame.calls[0] == ("coalesce", 4)


def test_scalars(spark):
    assert scalar(spark.sql("SELECT 5, 6")) == 5
    assert scalar(spark.sql("SELECT 5 WHERE false")) is None
    assert scalar(spark.sql("SELECT max(1) WHERE false")) is None
    assert scalar_timestamp(spark.sql("SELECT '2022-02-05T09:54:09.112'")) == datetime(2022, 2, 5, 9, 54, 9, 112000)


def test_zoneless_times_survive_any_session_zone(spark, db):
    spark.sql(f"CREATE TABLE {db}.t USING parquet AS SELECT TIMESTAMP_NTZ '2022-03-13 02:30:00.123' AS at")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert scalar_timestamp(spark.table(f"{db}.t")) == datetime(2022, 3, 13, 2, 30, 0, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("sql, expected", [
    ("SELECT true", True), ("SELECT 5, false", True), ("SELECT 'true'", True), ("SELECT 'false'", False),
    ("SELECT 5, 5", True), ("SELECT 0", False), ("SELECT null", False), ("SELECT true WHERE false", False)])
def test_gate(spark, sql, expected):
    assert gate(spark.sql(sql)) is expected


def test_parameters_and_names(spark, db):
    spark.sql(f"CREATE TABLE {db}.t USING parquet AS SELECT id FROM range(10)")
    assert read_table(spark, f"{db}.t").count() == 10
    assert extract(spark, f"SELECT * FROM {db}.t WHERE id > :low OR :low IS NULL", {"low": 7}).count() == 2
    assert extract(spark, f"SELECT * FROM {db}.t WHERE id > :low OR :low IS NULL", {"low": None}).count() == 10
    assert substitute("${a} ${b}", {"a": 1}) == "1 ${b}"
    assert table_exists(spark, f"{db}.t") and not table_exists(spark, f"{db}.u")
    with pytest.raises(LoadError):
        extract(spark, f"CREATE TABLE IF NOT EXISTS {db}.made (a INT) USING parquet")


def test_a_datetime_parameter_is_zoneless(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = extract(spark, "SELECT :at AS at, typeof(:at) AS kind", {"at": datetime(2024, 1, 1, 10, 0, 0, 5)}).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == (datetime(2024, 1, 1, 10, 0, 0, 5), "timestamp_ntz")


def test_staged_extract_sees_earlier_steps_and_context(spark):
    run_context(spark, ["DECLARE OR REPLACE VARIABLE low INT DEFAULT 7"])
    got = staged_extract(spark, [("step_one", "SELECT id FROM range(10) WHERE id > low"),
                                 ("step_two", "SELECT id * :factor AS id FROM step_one")],
                         "SELECT sum(id) AS total FROM step_two", {"factor": 10})
    assert values(got) == [(170,)]


def test_even_splits_cover_every_row_once(spark):
    from tablehaul.sources import EvenSplits, even_bounds, read_jdbc, split_predicates

    rows = spark.range(4000).selectExpr("CASE WHEN id % 40 = 0 THEN NULL WHEN id % 5 = 0 THEN 7 ELSE id * id END AS k")
    predicates = split_predicates("k", even_bounds(rows, "k", 8))
    assert sum(rows.where(p).count() for p in predicates) == 4000 and len(predicates) > 5
    assert max(rows.where(p).count() for p in predicates) < 700 + 500  # 700 rows share one value, and 500 are a part
    assert split_predicates("k", even_bounds(rows.limit(0), "k", 8)) == ["1 = 1"] and even_bounds(rows, "k", 1) == []
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS d")
    parts = split_predicates("d", even_bounds(days, "d", 4))
    assert len(parts) == 4 and sum(days.where(p).count() for p in parts) == 366
    with pytest.raises(LoadError):
        read_jdbc(spark, {"url": "jdbc:h2:x"}, "select 1", ranges=EvenSplits("k", 4), single=True)
