"""Where intermediate results are kept between steps."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local.get("dir") is None:
        _local["dir"] = tempfile.mkdtemp(prefix="qlens-checkpoint-")
    return _local["dir"]


_local: dict[str, str | None] = {"dir": None}


def kept(df: DataFrame) -> DataFrame:
    """The same rows however often they are read again, as a parquet table.

    Written to the shared checkpoint folder, so the rows outlive lost executors
    and later reads are pruned to the columns they use.
    """
    spark = df.sparkSession
    path = join_path(checkpoint_dir(spark), f"kept-{uuid.uuid4().hex}")
    for folders in _tidied:
        folders.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_tidied: list[list[str]] = []


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Deletes at the end of a ``with`` block whatever ``kept`` wrote in it, by whichever function.

    For a caller that has written down the results it wants in a folder of its own.
    """
    folders: list[str] = []
    _tidied.append(folders)
    try:
        yield
    finally:
        _tidied.remove(folders)
        for folder in folders:
            delete(spark, folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``kept`` for the length of a ``with`` block: its folders go when the block ends.

    What outlives the block must not read them.
    """
    folders: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        folders.append(join_path(checkpoint_dir(spark), f"kept-{uuid.uuid4().hex}"))
        df.write.parquet(folders[-1])
        return spark.read.schema(df.schema).parquet(folders[-1])

    try:
        yield keep
    finally:
        for folder in folders:
            delete(spark, folder)


@contextmanager
def setting(spark: SparkSession, key: str, value: str | int) -> Iterator[None]:
    """A session setting for the length of a ``with`` block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder wherever Spark's file systems can reach it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def in_memory(df: DataFrame) -> DataFrame:
    """A result of a few rows, bounded by the days of a period, that no longer depends on stored data."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def stable(df: DataFrame) -> DataFrame:
    """Like ``kept``, for when the order of rows and partitions matters as well."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


def join_path(base: str, *parts: str) -> str:
    return os.path.join(base.rstrip("/"), *parts)
