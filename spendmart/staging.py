"""Shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    A temporary folder stands in for it only in local mode: no other machine could read one.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spendmart-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder, on whatever file system it lies; whether there was one."""
    files, at = _at(spark, path)
    return files.delete(at, True)


class Stages:
    """Tables written one after another, of which only the last is still needed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: list[str] = []

    def next(self, df: DataFrame) -> DataFrame:
        """Write ``df``, which may read the table before, and remove the tables before."""
        path = new_path(self.spark, self.name)
        df.write.parquet(path)
        for old in self.paths:
            remove(self.spark, old)
        self.paths = [path]
        return self.spark.read.schema(df.schema).parquet(path)
