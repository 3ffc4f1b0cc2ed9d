"""Golden records and merged-id lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.operators.numbering import number_rows

# ids per text cell; a longer list continues in further parts
IDS_PER_PART = 10_000


def first_known(column: str, by: Sequence[Column]) -> Column:
    """Aggregate: the first non-null value in the order ``by``."""
    present = F.col(column).isNotNull()
    # min_by skips nothing by itself; a null order key does make it skip the row
    return F.min_by(F.col(column), F.when(present, F.struct(*by)))


def earliest_first(date_column: str, row_id: str) -> list[Column]:
    """Survivorship order: by date, missing dates last, ties by row id."""
    return [F.col(date_column).isNull(), F.col(date_column), F.col(row_id)]


def sorted_ids(id_column: str, separator: str = ", ", limit: int = IDS_PER_PART) -> Column:
    """Aggregate: ids of the group in order as one text, for groups of up to ``limit`` rows.

    Ids of larger groups are left out before collecting (``group_size`` comes with the linking
    result), so no task ever collects more than ``limit`` ids; :func:`with_id_text` fills those in.
    """
    small = F.when(F.col("group_size") <= limit, F.col(id_column))
    text = F.array_join(F.array_sort(F.collect_list(small)), separator)
    return F.when(F.max("group_size") <= limit, text)


def golden_records(
    linked: DataFrame,
    survivors: Sequence[str],
    date_column: str,
    row_id: str,
    extra: Mapping[str, tuple[Column, Column]],
) -> DataFrame:
    """One row per ``group_id``: first known value per survivor column plus the ``extra`` columns.

    ``extra``: ``{name: (aggregate over the group, the same for a single row)}``.  Unlinked rows,
    usually most of them, are only projected; the rows of larger groups alone are sorted, combined
    and shuffled.
    """
    order = earliest_first(date_column, row_id)
    single = linked.filter("group_size = 1").select(
        "group_id", *survivors, *[value.alias(name) for name, (_, value) in extra.items()]
    )
    grouped = linked.filter("group_size > 1").groupBy("group_id").agg(
        *[first_known(c, order).alias(c) for c in survivors],
        *[aggregate.alias(name) for name, (aggregate, _) in extra.items()],
    )
    return single.unionByName(grouped)


def membership(linked: DataFrame, id_column: str) -> DataFrame:
    """``(group_id, position, id)``: every id of every group of several rows, positions from 0 in the order of ids.

    Positions are counted range by range, so a group of any size takes as many tasks as it needs.
    """
    members = linked.filter("group_size > 1").select("group_id", F.col(id_column).alias("id")).filter("id is not null")
    return number_rows(members, [F.col("id")], "position", 0, ["group_id"]).select("group_id", F.col("position").cast("bigint").alias("position"), "id")


def merged_ids(
    linked: DataFrame, id_column: str, separator: str = ", ", per_part: int = IDS_PER_PART
) -> DataFrame:
    """``(group_id, part_no, record_ids, ids)``: :func:`membership` as texts of at most ``per_part`` ids."""
    parts = membership(linked, id_column).withColumn("part_no", F.expr(f"position div {per_part}"))
    return parts.groupBy("group_id", "part_no").agg(
        F.array_join(F.array_sort(F.collect_list("id")), separator).alias("record_ids"),
        F.count(F.lit(1)).alias("ids"),
    )


def long_id_texts(linked: DataFrame, id_column: str, separator: str = ", ", limit: int = IDS_PER_PART) -> DataFrame:
    """``(group_id, record_ids)`` of the groups of more than ``limit`` rows, each list whole.

    Sorted parts are joined in order, so a task holds one text, not the rows of its group.
    """
    parts = merged_ids(linked.filter(F.col("group_size") > limit), id_column, separator, limit)
    ordered = F.array_sort(F.collect_list(F.struct("part_no", "record_ids")))
    return parts.groupBy("group_id").agg(F.array_join(F.transform(ordered, lambda p: p["record_ids"]), separator).alias("record_ids"))


def with_id_text(golden: DataFrame, linked: DataFrame, id_column: str, text: str, limit: int = IDS_PER_PART) -> DataFrame:
    """``golden`` with :func:`sorted_ids` in ``text`` completed for the groups beyond its limit."""
    long = long_id_texts(linked, id_column, limit=limit).withColumnRenamed("record_ids", "__ids")
    return golden.join(long, "group_id", "left").withColumn(text, F.coalesce(F.col(text), "__ids")).select(*golden.columns)
