"""Where intermediate tables of a session go."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"
_cleared_on_exit: set[str] = set()
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Without a checkpoint folder it is the warehouse, which all executors share too.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.conf.get(WAREHOUSE_SETTING)
    return folder.rstrip("/")


def session_root(spark: SparkSession) -> str:
    """This application's own folder there; it is removed when the session's JVM ends."""
    root = f"{shared_folder(spark)}/ratesmith-{spark.sparkContext.applicationId}"
    if root not in _cleared_on_exit:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _cleared_on_exit.add(root)
    return root


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{session_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a written table: cut lineage that survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.mode("error").option("compression", "zstd").parquet(path)
    for paths in _scopes:
        paths.append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def noted():
    """Collects the paths of all tables staged inside."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)
