"""Where intermediate results are kept: always in a folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset, one inside the session's warehouse, which is shared too."""
    known = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return known or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`fresh_dir` named, through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute once into a fresh shared folder and read back: a cut of lineage whose files outlive executors."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``keep(df, name)`` for one run: like :func:`written`, but into a folder that goes when the run ends, however it ends. What outlives the run is to be written elsewhere."""
    root = fresh_dir(spark, name)

    def keep(df: DataFrame, part: str) -> DataFrame:
        path = f"{root}/{part}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        remove_dir(spark, root)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """While the block runs, rows travel to Python in batches of at most this size. A task holds a batch in the JVM and one or two in Python, and rows with texts fill the usual batch of 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint, which outlives executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
