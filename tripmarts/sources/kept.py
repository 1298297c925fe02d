"""Small intermediate results that several steps read: stored while a scope is open, then removed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[list[Callable[[], object]] | None] = ContextVar("scope of kept rows", default=None)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that driver and executors share, if the session names one."""
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)


@contextmanager
def keeping() -> Iterator[None]:
    """What `kept` makes in this block, also in threads that copy its context, is removed at its end."""
    made: list[Callable[[], object]] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for release in made:
            release()


def kept(rows: DataFrame) -> DataFrame:
    """The same rows, computed once.

    With a shared folder they are stored there, out of reach of a lost executor. Otherwise they are
    cached, and a block lost with its executor is computed again, by the same plan and the same
    shuffles. Outside `keeping` they stay until the folder is cleared or the session ends.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark)
    if folder:
        path = f"{folder}/held-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        found, release = spark.read.schema(rows.schema).parquet(path), partial(remove, spark, path)
    else:
        found = rows.persist(StorageLevel.MEMORY_AND_DISK)
        release = found.unpersist
    made = _scope.get()
    if made is not None:
        made.append(release)
    return found


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep a small pre-aggregate while several results are built from it."""
    with keeping():
        yield kept(rows)
