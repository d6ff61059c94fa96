"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows that a task of a join or an aggregation sorts, about, and bytes up to which small partitions and files are put together.
_PART_ROWS, _PART_BYTES = 500_000, 8 << 20
_PARTS, _TOGETHER = "spark.sql.shuffle.partitions", ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one stands in only where all tasks run on the driver's machine."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="casequarry-checkpoint-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


#: Lets the shuffle files of a finished execution go at once; unset is the same as false.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write compressed Parquet, in files that a task can read and sort whole; the shuffle files of doing so go at once."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", _PART_ROWS).parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out to all tasks by ``keys`` before a costly step: a join of few bytes may else leave them in one task."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def parts(spark: SparkSession, rows: int) -> int:
    """Partitions of a table of so many rows: no fewer than the session's, and as many more as the rows need."""
    return max(int(spark.conf.get(_PARTS)), -(-rows // _PART_ROWS))


@contextmanager
def parted(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written meanwhile is shuffled into ``parts`` of so many rows, so a task's memory does not grow with them."""
    before = {key: spark.conf.get(key) for key in (_PARTS, *_TOGETHER)}
    spark.conf.set(_PARTS, parts(spark, rows))
    for key in _TOGETHER:
        spark.conf.set(key, _PART_BYTES)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def written(df: DataFrame) -> DataFrame:
    """Write a table that several parts of a plan read, and read it back: nothing is kept in executors' memory or lost with them."""
    path = new_path(df.sparkSession)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
