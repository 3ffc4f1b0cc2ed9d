"""Row numbers over a whole table or within keys, by ranges of the order.

Spark sorts the rows into ranges and writes them; the offset of a range is the number of rows before
it.  No task sees more than its range, also when one key holds most rows, and because the ranges are
a written table, a task that runs again numbers its rows alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktidy.workspace import stage

_PART, _AT, _BEFORE = "__part", "__at", "__before"
_INDEX_BITS = 33  # monotonically_increasing_id() holds the partition above them, the row below


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_number", start: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with the column ``name``: dense numbers from ``start`` in ``order``, within ``keys`` if given.

    ``order`` should be total; equal rows are numbered in any order.  Null keys are a key of their own.
    """
    by = [F.col(k) for k in keys]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(width, *by, *order).sortWithinPartitions(*by, *order)
    ranged = ranged.withColumn(_AT, F.monotonically_increasing_id())
    ranged = stage(ranged.withColumn(_PART, F.shiftright(_AT, _INDEX_BITS)).withColumn(_AT, F.col(_AT).bitwiseAND((1 << _INDEX_BITS) - 1)), "ranges")
    if not keys:
        # one row for each range
        sizes = ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
        offsets = sizes.select(_PART, F.coalesce(before, F.lit(0)).alias(_BEFORE))
        return ranged.join(F.broadcast(offsets), _PART).withColumn(name, F.col(_AT) + F.col(_BEFORE) + start).drop(_PART, _AT, _BEFORE)
    # only the first and the last key of a range go on in another: two rows a range at most
    edges = ranged.groupBy(_PART).agg(F.min_by(F.struct(*keys), _AT).alias("first"), F.max_by(F.struct(*keys), _AT).alias("last"))
    edges = edges.select(F.explode(F.array("first", "last")).alias("k")).select("k.*").distinct()
    same = [ranged[k].eqNullSafe(edges[k]) for k in keys]
    shares = ranged.join(F.broadcast(edges), same, "left_semi").groupBy(*keys, _PART).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    offsets = shares.select(*keys, _PART, before.alias(_BEFORE)).filter(F.col(_BEFORE).isNotNull()).alias("o")
    local = F.row_number().over(Window.partitionBy(_PART, *keys).orderBy(_AT))
    numbered = ranged.withColumn(_AT, local).alias("r")
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*keys, _PART)]
    joined = numbered.join(F.broadcast(offsets), on, "left")
    return joined.select(*[F.col(f"r.{c}").alias(c) for c in df.columns], (F.col(f"r.{_AT}") + F.coalesce(f"o.{_BEFORE}", F.lit(0)) + (start - 1)).alias(name))
