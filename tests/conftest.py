import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablehaul.workspace import clean_up, scratch_database  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.driver.memory", "6g").getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def db(spark):
    yield scratch_database(spark)
    clean_up(spark)


def values(df, *columns):
    """All rows as sorted tuples."""
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan(df):
    """The final physical plan, after the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
