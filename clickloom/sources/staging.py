"""Intermediate tables kept in the shared folder the cluster names.

A staged table is plain parquet, so it outlives lost executors, cuts the
lineage of iterative work, and reports its true size to the optimizer: Spark
then broadcasts it in joins only while it is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
#: The folder of each staged table that is still referred to.
_paths: dict[int, str] = {}
#: Whether the shuffle files of a query go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
#: Files of a table that joins may copy whole: as rows of a hash table they are up to 20 times as large.
MODEST_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="clickloom-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    With ``release`` Spark deletes the write's shuffle files as soon as it is done,
    and not at some later garbage collection.
    """
    path = fresh_path(df.sparkSession, name)
    if release:
        with _released_shuffles(df.sparkSession):
            df.write.parquet(path)
    else:
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[id(table)] = path
    weakref.finalize(table, _paths.pop, id(table), None)
    return table


@contextmanager
def _released_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextmanager
def modest_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins planned meanwhile copy a table whole, by way of the driver, only below ``MODEST_BYTES`` of files."""
    before = spark.conf.get(_BROADCAST)
    allowed = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    spark.conf.set(_BROADCAST, str(min(allowed, MODEST_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_BROADCAST, before)


def discard(table: DataFrame) -> None:
    """Delete a staged table that nothing reads any more; any other table is left alone."""
    path = _paths.pop(id(table), None)
    if path is not None:
        context = table.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
