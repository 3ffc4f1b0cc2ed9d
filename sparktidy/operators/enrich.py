"""Lookup joins against a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktidy.operators import skew
from sparktidy.operators.skew import HASHED_BYTES, fits_hashed, lookup_per_key, text_bytes
from sparktidy.workspace import stage

# a dimension is broadcast only after its size was measured
BROADCAST_BYTES = 64 << 20


class RepeatedKeysError(ValueError):
    """The dimension holds a key more than once."""


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """``(key, rows)`` of keys that occur more than once; null counts as a key."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def measured_bytes(df: DataFrame) -> int:
    """Text size of the whole table, from one aggregate."""
    return df.agg(F.sum(text_bytes(df.columns))).first()[0] or 0


def validate_many_to_one(dimension: DataFrame, key: str) -> int:
    """Raise if a key repeats, naming some; otherwise return the measured size, from the same job."""
    per_key = dimension.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(text_bytes(dimension.columns)).alias("bytes")
    )
    most, size = per_key.agg(F.max("rows"), F.sum("bytes")).first()
    if (most or 0) > 1:
        found = repeated_keys(dimension, key).orderBy(key).limit(20).collect()
        raise RepeatedKeysError(f"{key} repeats in the lookup table: {[row[0] for row in found]}")
    return size or 0


def null_safe_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    row_id: str,
    matched: str = "matched",
    max_broadcast_bytes: int = BROADCAST_BYTES,
    dimension_bytes: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join where a null key matches a null key, with a ``matched`` indicator.

    A dimension measured below the limit is broadcast and the facts are not shuffled.  A larger one
    is joined by shuffle, hashed where its partitions are small, with the facts of heavy keys answered by a bounded broadcast.  Keys are counted in
    ``counted``, a table with the same keys as ``facts`` that costs less to read, if there is one.
    """
    flagged = dimension.withColumn(matched, F.lit(True))
    size = measured_bytes(dimension) if dimension_bytes is None else dimension_bytes
    if size <= max_broadcast_bytes:
        right = F.broadcast(flagged.withColumnRenamed(key, "__key"))
        joined = facts.join(right, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    else:
        weights = (facts if counted is None else counted).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
        # only of heavy keys the rows matter: few small ones, so the dimension is neither shuffled nor written for them
        heavy = weights.filter((F.col("__rows") >= skew.HEAVY_ROWS) & (text_bytes(["__key"]) <= skew.HEAVY_BYTES))
        heavy = stage(heavy.orderBy(F.desc("__rows"), "__key").limit(skew.HEAVY_KEYS), "heavy")
        per_key = (
            flagged.join(F.broadcast(heavy), F.col(key).eqNullSafe(F.col("__key")), "left")
            .drop("__key").fillna(0, ["__rows"])
        )
        hashed = fits_hashed(facts.sparkSession, size, HASHED_BYTES)
        joined = lookup_per_key(facts, per_key, [key], weight="__rows", spread_by=row_id, hashed=hashed).drop("__rows")
    return joined.withColumn(matched, F.coalesce(F.col(matched), F.lit(False)))


def enrich(facts: DataFrame, dimension: DataFrame, key: str, row_id: str, **options) -> DataFrame:
    """Validated many-to-one lookup; see :func:`null_safe_lookup`."""
    size = validate_many_to_one(dimension, key)
    return null_safe_lookup(facts, dimension, key, row_id, dimension_bytes=size, **options)


def unmatched_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct fact keys without a partner in the dimension; null matches null."""
    left = facts.select(key).distinct()
    right = dimension.select(F.col(key).alias("__key")).distinct()
    return left.join(right, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
