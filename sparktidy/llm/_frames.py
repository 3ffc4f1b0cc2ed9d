"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

BROADCAST_BYTES = 32 << 20


def _bytes(value: Column, kind: DataType) -> Column:
    """About how many bytes a value takes in a row."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind), F.lit(8).cast("bigint"))
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, (StringType, BinaryType, StructType, ArrayType)):
            whole = F.aggregate(value, F.lit(16).cast("bigint"), lambda total, item: total + _bytes(item, kind.elementType))
            return F.coalesce(whole, F.lit(8).cast("bigint"))
        return F.coalesce(F.size(value), F.lit(0)).cast("bigint") * 8 + 16
    return F.lit(8).cast("bigint")


def bounded(side: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``side``, marked for broadcast only if its rows take few bytes; a shuffle join takes the others."""
    row = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in side.schema), F.lit(16).cast("bigint"))
    return F.broadcast(side) if (side.agg(F.sum(row)).first()[0] or 0) <= max_bytes else side


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def sample_by_hash(df: DataFrame, column: str, rows: int) -> DataFrame:
    """About ``rows`` rows, or all if there are no more: those whose id has a small hash.

    It depends on the rows alone, and no task gathers candidates of the others.
    """
    total = df.count()
    if total <= rows:
        return df
    scale = 1 << 40
    return df.filter(F.pmod(F.xxhash64(column, F.lit(17)), F.lit(scale)) < int(scale * rows / total))


def sample_by_count(df: DataFrame, column: str, rows: int) -> DataFrame:
    """At most about ``rows`` of the distinct rows, with the ``weight`` of each; ``column`` decides the others.

    A value of ``n`` rows is taken with ``n`` times the chance of a single one, by its hash, and
    surely from a chance of one on; it then weighs as many rows of the sample as its share.
    """
    share = min(1.0, rows / max(df.count(), 1))
    scale = 1 << 40
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    drawn = counted.filter(F.pmod(F.xxhash64(column, F.lit(17)), F.lit(scale)) < F.col("weight") * F.lit(scale * share))
    return drawn.withColumn("weight", F.greatest(F.col("weight") * share, F.lit(1.0)))
