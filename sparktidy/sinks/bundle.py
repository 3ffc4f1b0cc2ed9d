"""A report of several named tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def write_report(tables: Mapping[str, DataFrame], path: str, order: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One Parquet directory per table plus ``manifest``; returns the manifest.

    ``(name, rows, columns)``; the counts come from the written files, not from a second run.  With the
    columns by which tables are delivered in ``order`` there is also ``parts``, which proves it:
    see :func:`ordered_parts`.
    """
    first = next(iter(tables.values()))
    spark = first.sparkSession
    counted, parts = [], []
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
        written = spark.read.schema(table.schema).parquet(f"{path}/{name}")
        counted.append(
            written.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("name"),
                "rows",
                F.lit(len(table.columns)).cast("bigint").alias("columns"),
            )
        )
        if order and name in order:
            parts.append(ordered_parts(written, order[name]).select(F.lit(name).alias("name"), "*"))
    manifest = reduce(DataFrame.unionAll, counted)
    manifest.coalesce(1).write.parquet(f"{path}/manifest")
    if parts:
        reduce(DataFrame.unionAll, parts).write.parquet(f"{path}/parts")
    return spark.read.schema(manifest.schema).parquet(f"{path}/manifest")


def ordered_parts(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(part, rows, least, greatest, inversions, follows)`` for each file of a written table.

    ``least`` and ``greatest`` are its keys as text, ``inversions`` the rows smaller than the row before them, and
    ``follows`` says whether the file starts no lower than the file before it ended.  A table is in order
    if every file follows without inversions, and a reader can see that without reading the table.
    """
    rows = written.select(F.struct(*keys).alias("key"), F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("key").over(Window.partitionBy("part").orderBy("at"))
    parts = rows.withColumn("less", F.coalesce(F.col("key") < before, F.lit(False)).cast("int")).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("least"), F.max("key").alias("greatest"), F.sum("less").alias("inversions")
    )
    # one row for each file
    earlier = F.max("greatest").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    follows = F.coalesce(F.col("least") >= earlier, F.lit(True))
    return parts.select("part", "rows", F.to_json("least").alias("least"), F.to_json("greatest").alias("greatest"), "inversions", follows.alias("follows"))


def delivered_order(spark, path: str) -> DataFrame:
    """``(name, rows, in_order)`` of the tables with a promised order, from the manifest of their parts alone."""
    proven = F.bool_and(F.col("follows") & (F.col("inversions") == 0))
    return spark.read.parquet(f"{path}/parts").groupBy("name").agg(F.sum("rows").alias("rows"), proven.alias("in_order"))


def read_report(spark, path: str) -> dict[str, DataFrame]:
    """The tables of a bundle by name."""
    names = [row["name"] for row in spark.read.parquet(f"{path}/manifest").collect()]
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
