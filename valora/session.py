"""Session defaults and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE picks join strategies, splits skewed join partitions and coalesces small
# shuffle partitions at run time; everything else is left to the cluster.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(app_name: str = "valora", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the package defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a local one is set up only when none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="valora-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


#: Paths of the tables that each open ``scratch_tables`` block has written, the innermost last.
_scopes: list[list[str]] = []


def materialize(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder.

    Unlike executor-local storage the table survives the loss of executors, and
    unlike a cached frame it can be read by several later jobs without keeping memory. Inside ``scratch_tables``
    it goes with the block, or if it is ``kept`` with the block around it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    if len(_scopes) > kept:
        _scopes[-1 - kept].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Tables stored inside the block are removed when it ends, but for those that are ``kept``: what leaves the block may read no others."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark writes to."""
    place, files = _place(spark, path)
    files.delete(place, True)


def drop_stored(df: DataFrame) -> None:
    """Remove the folder of a table that ``materialize`` returned, before its block ends; nothing may read it any more."""
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        remove(df.sparkSession, folder)


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)
