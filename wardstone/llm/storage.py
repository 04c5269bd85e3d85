"""Results that survive a lost executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of our own where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="wardstone-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Rows that go to Python and back at a time, where rows hold whole texts.
TEXT_ROWS = 500


def modest_batches(spark: SparkSession) -> None:
    """Lets the session send at most TEXT_ROWS rows to Python at once: Spark's own bound is made for narrow rows, and its
    buffers, on either side, follow the widest batch. A smaller setting of the user's stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXT_ROWS:
        spark.conf.set(name, str(TEXT_ROWS))


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """For tables made in it, Spark deletes the shuffle files of a step as soon as the step has ended; else they lie there
    until the driver happens to collect its garbage, those of all steps at once. A table that a caller may run more than
    once is better made outside, since its second run would have to make its shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and written to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/wardstone-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
