"""Durable intermediate tables in the folder the cluster shares.

A written table survives the loss of executors, keeps its statistics for the
planner and is computed once however often it is read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Tables made inside `released`, one list per open block.
_open: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or the folder set with ``setCheckpointDir``.

    Where neither is set and Spark runs in local mode (tests), a temporary
    folder is set. On a cluster the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="linkloom-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a scratch table and return a reader of that table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside the block at its end.

    Frames that read them are of no use afterwards, so write results first.
    """
    made: list[str] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for path in made:
            files, place = file_system(spark, path)
            files.delete(place, True)
