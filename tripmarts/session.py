"""Spark session with the settings every stage relies on."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Raw times are UTC wall clocks, so every hour / date / month must be read in UTC.
SESSION_ZONE = "UTC"
# Files that a task holds open while it writes a layer; a task with more partitions sorts the rows of the others.
OPEN_FILES = 32
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def pin_session_zone(spark: SparkSession) -> SparkSession:
    """Expressions take their zone when they are analysed, so call this before building plans."""
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    return spark


@contextmanager
def files_side_by_side(spark: SparkSession) -> Iterator[None]:
    """Writes by partition in this block keep several files open instead of sorting all rows of a task.

    For rows without an order of their own: those beyond `OPEN_FILES` partitions are sorted by partition.
    """
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def get_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Build or reuse a session; `conf` wins over the defaults below.

    Executor counts and memory belong to spark-submit. Shuffle width is only an upper bound
    here, as adaptive execution merges small partitions and splits skewed ones.
    """
    settings = {
        "spark.sql.session.timeZone": SESSION_ZONE,
        # Noting the call site of every column expression costs several round trips to the JVM.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if "SHUFFLE_PARTITIONS" in os.environ:
        settings["spark.sql.shuffle.partitions"] = os.environ["SHUFFLE_PARTITIONS"]
    settings.update(conf)

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("SPARK_LOG_LEVEL", "WARN"))
    return spark
