"""Summary rows that an export appends below its data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy import rulepack
from sparktidy.functions.numbers import parse_pl_number, to_money
from sparktidy.functions.text import clean_text
from sparktidy.operators.columns import quoted


def is_total_row(first_cell: Column, labels: Sequence[str] = rulepack.TOTAL_LABELS) -> Column:
    # cleaning changes white space only, so a cell that lacks the longest word of every label needs none
    upper, words = F.upper(first_cell), {max(label.split(), key=len, default="") for label in labels}
    hint = reduce(or_, [F.contains(upper, F.lit(word)) for word in sorted(words)], F.lit(False))
    return F.coalesce(hint & F.upper(clean_text(first_cell)).isin(list(labels)), F.lit(False))


def extract_control_totals(
    df: DataFrame,
    first_column: str,
    last_column: str,
    row_id: str,
    source: str,
    total: str = "suma_z_pliku",
) -> tuple[DataFrame, DataFrame]:
    """``(data rows, controls)``.

    ``controls`` has one row per source with summary rows: the declared total from the last column
    of the first of them (null if unreadable), and how many were removed.
    """
    flag = is_total_row(F.col(quoted(first_column)))
    controls = (
        df.filter(flag)
        .groupBy(source)
        .agg(
            F.min_by(F.col(quoted(last_column)), F.col(row_id)).alias("__declared"),
            F.count(F.lit(1)).alias("total_rows"),
        )
        .select(source, to_money(parse_pl_number(F.col("__declared"))).alias(total), "total_rows")
    )
    return df.filter(~flag), controls
