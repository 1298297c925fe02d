"""What several corpus operators share: reading tables, words, stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, newline, \v, \f and return.
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once for each row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def unused(name: str, columns: list[str]) -> str:
    """The name with as many underscores before it as no column needs, in either case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for a null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    empty = F.array().cast("array<string>")
    return F.when(trimmed == "", empty).otherwise(F.split(trimmed, f"[{SPACES}]+"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Without one, a local session gets a temporary folder; a cluster is refused, since its
    executors would not see such a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def stored(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage, survives lost executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove a table made by `stored` that nothing reads any more."""
    jvm = frame.sparkSession._jvm
    conf = frame.sparkSession._jsc.hadoopConfiguration()
    for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
