"""Exact and keyed duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.operators.skew import fits_hashed, key_marks, lookup_per_key
from sparktidy.workspace import stage

# repeated keys take about 100 bytes each and are broadcast up to 64 MB
KEY_BYTES = 100
BROADCAST_KEYS = (64 << 20) // KEY_BYTES


def dedup_exact(
    df: DataFrame, row_id: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per distinct row (null = null).

    With ``row_id`` the first id survives and ``copies`` counts the identical rows, which is all
    that the change log needs.  Partial aggregation absorbs a row pasted any number of times.
    """
    if row_id is None:
        return df.dropDuplicates()
    columns = list(columns or [c for c in df.columns if c != row_id])
    return df.groupBy(*columns).agg(
        F.min(row_id).alias(row_id), F.count(F.lit(1)).alias("copies")
    )


def mark_repeats(
    df: DataFrame, keys: Sequence[str], row_id: str, only_where: Column, flag: str = "is_repeat"
) -> DataFrame:
    """Flag every row but the first of its key, among rows ``only_where`` holds; null = null.

    Keys go by 128-bit marks, so wide ones cost no more than narrow ones.  Rows are shuffled only if the
    repeated keys, once counted, are too many for a broadcast, and sorted for it only if they are too many to be hashed.
    """
    holds = F.coalesce(only_where, F.lit(False))
    marks = ["__mark1", "__mark2"]
    eligible = df.filter(holds).select("*", *key_marks(keys, marks))
    firsts = (
        eligible.groupBy(*marks)
        .agg(F.min(row_id).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1")
    )
    firsts = stage(firsts, "firsts")
    repeated = firsts.count()
    if repeated <= BROADCAST_KEYS:
        marked = F.broadcast(firsts.drop("__n")).join(eligible, marks, "right")
    else:
        hashed = fits_hashed(df.sparkSession, repeated * KEY_BYTES)
        marked = lookup_per_key(eligible, firsts, marks, weight="__n", spread_by=row_id, eligible=F.lit(True), hashed=hashed)
    repeats = marked.withColumn(flag, F.coalesce(F.col(row_id) > F.col("__first"), F.lit(False)))
    # the other rows are read once more, but neither shuffled nor joined
    return repeats.select(*df.columns, flag).unionByName(df.filter(~holds).withColumn(flag, F.lit(False)))


def dedup_keep_first(
    df: DataFrame, keys: Sequence[str], row_id: str, required: str
) -> tuple[DataFrame, DataFrame]:
    """``(kept, removed)``: the first row per key in ``row_id`` order, where ``required`` is present.

    Rows without ``required`` are always kept.
    """
    marked = mark_repeats(df, keys, row_id, F.col(required).isNotNull())
    return (
        marked.filter("not is_repeat").drop("is_repeat"),
        marked.filter("is_repeat").drop("is_repeat"),
    )
