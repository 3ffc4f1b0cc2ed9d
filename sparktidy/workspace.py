"""Shared scratch storage for intermediate results.

Intermediates that several jobs read are written once to the folder the cluster names in
``spark.checkpoint.dir``.  A written table survives lost executors, is read back column by column
and, unlike a cache, takes no executor memory.  It is compressed with zstd, a third smaller than the default.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

COMPRESSION = "zstd"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="sparktidy-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, removed when the application ends."""
    root = f"{shared_dir(spark)}/sparktidy-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    storage = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if storage.mkdirs(path):
        storage.deleteOnExit(path)
    return f"{root}/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, counts: Mapping[str, Column]) -> tuple[DataFrame, dict]:
    """:func:`stage`, with aggregates of the rows that are taken while they are written.

    They come with the finished tasks of the write, once for each, so there is no second scan.
    """
    watch = Observation(name)
    return stage(df.observe(watch, *[c.alias(n) for n, c in counts.items()]), name), watch.get


class Rounds:
    """Staged tables of an iterative operator, of which only the last ones are needed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: list[str] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as the next table."""
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path, compression=COMPRESSION)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_all_but(self, last: int) -> None:
        """Remove the tables of earlier rounds; nothing may read them any more."""
        gone = self.paths[: len(self.paths) - last]
        self.paths = self.paths[len(gone) :]
        for path in gone:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for the rounds of an iterative operator."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
