"""Shared scratch storage and cutting lineage."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="playthrough-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the one the session was given.

    Only a local session may go without one: there the driver's own disk is every executor's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, on reliable shared storage, and continue from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same as a table in the shared folder: columns can be pruned, and the planner knows the size."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt evenly over the tasks by columns of many values, wherever the work before has put them.

    What follows a window by few keys would otherwise run in one task per key.
    """
    return df.repartition(*columns)


def remove(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    context = df.sparkSession.sparkContext
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
