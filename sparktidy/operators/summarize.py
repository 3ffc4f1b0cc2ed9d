"""Pivots with totals, rankings, reconciliation, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktidy import rulepack


def pivot_values(df: DataFrame, column: str) -> list[str]:
    """The values that become columns, in order.  Columns must be few; Spark's pivot limit applies."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values and cannot become columns")
    return sorted(row[0] for row in found)


def pivot_sum(
    df: DataFrame, key: str, across: str, value: str, across_values: Sequence[str] | None = None
) -> DataFrame:
    """``key`` x ``across`` sums; null keys are left out, an absent combination is null."""
    names = list(across_values) if across_values is not None else pivot_values(df, across)
    known = df.filter(F.col(key).isNotNull() & F.col(across).isNotNull())
    return known.groupBy(key).pivot(across, names).agg(F.sum(value))


def pivot_with_totals(
    df: DataFrame,
    key: str,
    across: str,
    value: str,
    across_values: Sequence[str] | None = None,
    total: str = rulepack.MARGIN_LABEL,
) -> DataFrame:
    """:func:`pivot_sum` with a total column and a total row.

    The facts are aggregated once to (key, across); the margins roll up that small table.
    """
    names = list(across_values) if across_values is not None else pivot_values(df, across)
    cells = (
        df.filter(F.col(key).isNotNull() & F.col(across).isNotNull() & F.col(value).isNotNull())
        .groupBy(key, across)
        .agg(F.sum(value).alias("__cell"))
    )
    rolled = cells.rollup(key).agg(
        F.grouping(key).alias("__margin"),
        *[F.sum(F.when(F.col(across) == name, F.col("__cell"))).alias(name) for name in names],
        F.sum("__cell").alias(total),
    )
    return rolled.withColumn(
        key, F.when(F.col("__margin") == 1, F.lit(total)).otherwise(F.col(key))
    ).drop("__margin")


def top_groups(
    df: DataFrame, keys: Sequence[str], measures: dict[str, Column], by: str, n: int = 10
) -> DataFrame:
    """The ``n`` groups with the largest ``by``; null is a key value, ties go by key."""
    return df.groupBy(*keys).agg(
        *[m.alias(name) for name, m in measures.items()]
    ).orderBy(F.desc(by), *keys).limit(n)


def reconcile(
    facts: DataFrame,
    controls: DataFrame,
    source: str,
    value: str,
    expected: str = "suma_z_pliku",
    actual: str = "suma_po_scaleniu",
    verdict: str = "zgodne",
    kept: Column | None = None,
    apart: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Compare the declared total of each source with the sum of its rows.

    ``controls``: one row per source that declares a total.  An unreadable total never agrees.  With
    ``kept`` only those rows count; ``apart`` adds columns with the amounts of rows that were left out,
    all from one aggregate, so a difference can be traced to where it was lost.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    amount = F.col(value) if kept is None else F.when(kept, F.col(value))
    others = {name: F.sum(F.when(condition, F.col(value))) for name, condition in (apart or {}).items()}
    sums = facts.groupBy(source).agg(F.sum(amount).alias(actual), *[total.alias(name) for name, total in others.items()])
    difference = F.abs(F.col(expected) - F.col(actual))
    joined = controls.select(source, expected).join(sums, source, "left")
    filled = joined.withColumns({name: F.coalesce(F.col(name), zero) for name in (actual, *others)})
    return filled.withColumn(verdict, F.when(difference < 0.01, rulepack.AGREES).otherwise(rulepack.DIFFERS))


def total_difference(checks: DataFrame, expected: str = "suma_z_pliku", actual: str = "suma_po_scaleniu") -> DataFrame:
    """Sum of absolute differences, 0 when nothing was declared."""
    gap = F.sum(F.abs(F.col(expected) - F.col(actual)))
    return checks.agg(F.coalesce(gap, F.lit(0).cast("decimal(18,2)")).alias("control_difference"))


def sample_per_group(
    df: DataFrame, group: str, preferred: Column, order_by: Sequence[str], sizes: dict[str, int], default: int = 1
) -> DataFrame:
    """The first n rows per group: preferred ones if the group has at least n, else any.

    Both candidate lists are ranked windows with a row limit, which Spark applies before the
    shuffle, so a group that holds most of the rows sends only n of them per input partition.
    """
    largest = max([default, *sizes.values()])
    wanted = F.lit(default)
    for name, n in sizes.items():
        wanted = F.when(F.col(group) == name, n).otherwise(wanted)

    def head(pool: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(group).orderBy(*order_by))
        return pool.withColumn("__rank", rank).filter(F.col("__rank") <= largest)

    chosen = F.coalesce(preferred, F.lit(False))
    candidates = (
        head(df.filter(chosen)).withColumn("__preferred", F.lit(True))
        .unionByName(head(df).withColumn("__preferred", F.lit(False)))
        .withColumn("__wanted", wanted)
        .filter("__rank <= __wanted")
    )
    # at most two short lists per group are left here
    enough = F.count_if(F.col("__preferred")).over(W.partitionBy(group)) >= F.col("__wanted")
    return (
        candidates.withColumn("__enough", enough)
        .filter("__preferred = __enough")
        .drop("__rank", "__wanted", "__enough", "__preferred")
    )
