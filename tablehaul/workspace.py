"""Shared folders, intermediate tables and scratch databases.

Everything written between two steps of a job goes under the folder named by ``spark.checkpoint.dir``, which all
executors can reach, so that a lost executor never takes intermediate results with it.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tablehaul.errors import LoadError


def unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh local one only for a local session that names none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise LoadError("Set spark.checkpoint.dir to a folder that every executor can reach")
    with _lock:
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.TemporaryDirectory(prefix="tablehaul-")  # removed when the process ends
        return _local[app].name


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the length of one action.

    Actions of several threads may overlap: the first sets it, the last restores what was there before. They must ask for
    the same value.
    """
    with _lock:
        _users[name] += 1
        if _users[name] == 1:
            _before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _lock:
            _users[name] -= 1
            if not _users[name]:
                before = _before.pop(name)
                if before is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, before)


_lock = threading.RLock()
_local: dict[str, tempfile.TemporaryDirectory] = {}
_users: Counter[str] = Counter()
_before: dict[str, str | None] = {}
_created: list[str] = []
_scratch: list[str] = []


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``clean_up`` removes it.

    This cuts the lineage, is computed a single time, survives executor loss, and gives the optimizer a real size, so
    that a later join broadcasts it only when its files are below the broadcast threshold.
    """
    return _stored(df, label)[0]


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{unique(label)}"
    _created.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def intermediate(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As ``materialize``, for use within one job: the files are gone afterwards. Jobs of several threads keep apart."""
    kept, path = _stored(df, label)
    try:
        yield kept
    finally:
        with _lock:
            if path in _created:
                _created.remove(path)
        remove_dir(df.sparkSession, path)


def scratch_database(spark: SparkSession) -> str:
    """Create an empty database of its own below the shared folder and return its name."""
    name = unique("scratch")
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{shared_dir(spark)}/{name}'")
    _scratch.append(name)
    return name


def clean_up(spark: SparkSession) -> None:
    """Remove the intermediate tables and scratch databases made so far; results built on them end here."""
    while _scratch:
        name = _scratch.pop()
        if not spark.catalog.databaseExists(name):  # made by an earlier session of this process
            continue
        location = spark.catalog.getDatabase(name).locationUri
        spark.sql(f"DROP DATABASE `{name}` CASCADE")
        remove_dir(spark, location)
    while _created:
        remove_dir(spark, _created.pop())


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_dir(spark: SparkSession, location: str) -> None:
    fs, path = _path(spark, location)
    fs.delete(path, True)


def make_dir(spark: SparkSession, location: str) -> None:
    fs, path = _path(spark, location)
    fs.mkdirs(path)


def child_dirs(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders directly below ``location``; empty when it does not exist."""
    fs, path = _path(spark, location)
    if not fs.exists(path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
