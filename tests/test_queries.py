"""Every registered query against its SQL."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare
from tablehaul.workspace import clean_up
from workload import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    outcome, _ = compare(spark, duck, name, contract.queries()[name], contract.oracle_sql()[name], FOLDER)
    clean_up(spark)
    assert outcome.startswith("ok") and "TYPES" not in outcome


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    clean_up(spark)
