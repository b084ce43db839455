"""Intermediate tables in the folder the session names in ``spark.checkpoint.dir``.

A staged table cuts lineage, survives lost executors, stays columnar, and gives
the planner its exact size: a join with it is broadcast only when that size is
under ``spark.sql.autoBroadcastJoinThreshold``, and is a shuffle join beyond it.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)
_local: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder of the session.

    Only a session in one process (``local[...]``) may do without: it gets a temporary
    folder. On a cluster the executors would write to disks of their own.
    """
    folder = _scratch.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
        if not folder:
            if not re.fullmatch(r"local(\[[^-]*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            if context.applicationId not in _local:
                _local[context.applicationId] = tempfile.mkdtemp(prefix="bazaarline-")
            folder = _local[context.applicationId]
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Everything staged inside goes to one folder, which is deleted at the end.

    Write the result inside the block: it may read staged tables.
    """
    folder = new_path(spark, "scratch")
    before = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(before)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by key over all shuffle partitions, small as they may be.

    For steps that cost much per row: adaptive execution would merge small
    partitions by their bytes and leave most cores idle.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(width, *keys)
