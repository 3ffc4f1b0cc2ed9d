"""Session settings that suit this engine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Wide rule projections generate methods above HotSpot's 8000-byte limit for compiling a method;
# beyond it the fused code would run interpreted.  With this limit Spark generates such a
# projection as several smaller methods instead.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# A batch of rows for Python is a buffer in the JVM, which doubles as it grows, and another in the worker,
# for each task.  Texts of some KB would make it tens of megabytes; narrow rows stay far below this.
BATCH_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def bound_batches(spark: SparkSession) -> SparkSession:
    """Apply :data:`BATCH_BYTES`, unless set for this application."""
    return _apply(spark, BATCH_BYTES)


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS`, except those set for this application."""
    return _apply(spark, SETTINGS)


def _apply(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    chosen = dict(spark.sparkContext.getConf().getAll())
    for name, value in settings.items():
        if name not in chosen:
            spark.conf.set(name, value)
    return spark
