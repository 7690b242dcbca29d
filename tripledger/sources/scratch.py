"""A place for intermediate tables that every executor can reach, and who removes them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_owner: ContextVar[list[str] | None] = ContextVar("owner", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or the context's checkpoint folder; one must be set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (paths := _owner.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def scratch_owner(spark: SparkSession) -> Iterator[None]:
    """Whatever is stored in the block is removed at its end: use or write all results within it.

    Without an owner stored tables stay in the shared folder, as frames that read them may be used at
    any later time.
    """
    paths: list[str] = []
    token = _owner.set(paths)
    try:
        yield
    finally:
        _owner.reset(token)
        _remove(spark, paths)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Run the plan once, keep its result in the scratch folder and return the stored table.

    This is a job of its own, run when the frame is made. The result outlives any executor, and Spark
    knows its size when planning what follows. See :func:`scratch_owner` for how long it is kept.
    """
    return _stored(df, scratch_path(df.sparkSession, name))


@contextmanager
def stored_within(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """What :func:`store` gives, removed at the end of the block: what is used later must not read it any more."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield _stored(df, path)
    finally:
        _remove(df.sparkSession, [path])


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
