"""Joining one row per key back to many rows per key, whatever the key distribution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# At most HEAVY_KEYS keys of at most HEAVY_BYTES each are broadcast, 20 MB however large the data is.
# Every other key holds less than 1/HEAVY_KEYS of the rows, which one shuffle partition can take.
HEAVY_KEYS = 5000
HEAVY_ROWS = 100_000
HEAVY_BYTES = 4096
_SPREAD = 1 << 16
# up to this many bytes of keys for each shuffle partition are hashed, more are sorted
HASHED_BYTES = 16 << 20


def text_bytes(columns: Sequence[str]) -> Column:
    """Size of a row as text."""
    width = F.lit(16 * len(columns)).cast("bigint")
    for c in columns:
        width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return width


def key_marks(keys: Sequence[str], names: Sequence[str] = ("__mark1", "__mark2")) -> list[Column]:
    """128 bits for the values of a key, null = null: what is shuffled and broadcast in place of wide keys."""
    parts = [p for k in keys for p in (F.col(k), F.col(k).isNull())]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in enumerate(names)]


def fits_hashed(spark: SparkSession, size: int, limit: int = HASHED_BYTES) -> bool:
    """Whether keys of ``size`` bytes, dealt over the shuffle partitions, can be hashed there."""
    return size <= limit * int(spark.conf.get("spark.sql.shuffle.partitions"))


def lookup_per_key(
    df: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    weight: str,
    spread_by: str,
    eligible: Column | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Left join ``per_key`` (unique, null-safe ``keys``; ``weight`` = rows per key in ``df``).

    ``per_key`` is read twice, so it should be a staged table or cheap.  The heaviest keys are answered by a broadcast join.  Their rows then carry a salt, so the
    shuffle join for all the other keys spreads them evenly instead of hashing them together.  Rows
    that are not ``eligible`` get nulls and are spread the same way.  ``hashed`` says that the keys of a partition fit
    into memory: then ``df`` is not sorted for the join, and if no key is heavy, it carries no salt either.
    """
    values = [c for c in per_key.columns if c not in keys]
    heavy = per_key.filter((F.col(weight) >= HEAVY_ROWS) & (text_bytes(per_key.columns) <= HEAVY_BYTES))
    if hashed and eligible is None and heavy.isEmpty():
        light = per_key.select(*[F.col(k).alias(f"__light_{k}") for k in keys], F.struct(*values).alias("__found"))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__light_{k}")) for k in keys])
        joined = df.join(light.hint("shuffle_hash"), same, "left")
        return joined.select(*df.columns, *[F.col(f"__found.{v}").alias(v) for v in values])
    heavy = heavy.orderBy(F.desc(weight), *keys).limit(HEAVY_KEYS)
    heavy = F.broadcast(
        heavy.select(
            *[F.col(k).alias(f"__heavy_{k}") for k in keys],
            F.struct(*values).alias("__heavy"),
        )
    )
    usable = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    matched = df.withColumn("__usable", usable).join(
        heavy,
        reduce(and_, [F.col(k).eqNullSafe(F.col(f"__heavy_{k}")) for k in keys], F.col("__usable")),
        "left",
    )
    salted = matched.withColumn(
        "__salt",
        F.when(F.col("__usable") & F.col("__heavy").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(F.col(spread_by)), F.lit(_SPREAD)).cast("int") + 1
        ),
    )
    light = per_key.select(
        *[F.col(k).alias(f"__light_{k}") for k in keys],
        F.struct(*values).alias("__light"),
        F.lit(0).alias("__light_salt"),
    )
    joined = salted.join(
        light.hint("shuffle_hash") if hashed else light,
        reduce(
            and_,
            [F.col(k).eqNullSafe(F.col(f"__light_{k}")) for k in keys],
            F.col("__salt") == F.col("__light_salt"),
        ),
        "left",
    )
    found = F.when(F.col("__usable"), F.coalesce(F.col("__heavy"), F.col("__light")))
    return joined.select(*df.columns, found.alias("__found")).select(
        *df.columns, *[F.col(f"__found.{v}").alias(v) for v in values]
    )
