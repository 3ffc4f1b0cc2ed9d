"""Lines of text files, numbered, and delimited records that quotes carry over line ends.

Whether a line begins a record depends on all lines before it, but only through one bit: is a quoted
cell open.  A line is a function of that bit, functions compose, and so the state at every line is a
prefix scan: per line within a split, then over one row per split.  A file is read in as many tasks
as it has splits; the reader's own ``multiLine`` mode would make each file one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktidy.sources.profile import SEPARATORS, raw_lines
from sparktidy.workspace import stage

LINE = "line_id"


def numbered_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """``(file, block, line_id, value)``: the staged lines of all files, ``value`` as raw bytes.

    ``line_id`` is dense from 0 over the files in the order of their names.  Each split counts its lines;
    its offset is the sum of the counts before it (one row per split), so nothing is sorted.
    """
    lines = stage(raw_lines(spark, paths).withColumn("value", F.col("value").cast("binary")), "lines")
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    before = F.sum("n").over(W.orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1))
    offsets = splits.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    numbered = lines.join(F.broadcast(offsets), ["file", "block"])
    return numbered.select("file", "block", (F.col("seq") + F.col("shift")).alias(LINE), "value")


def _at_cell_start(separator: str) -> str:
    return f"(^|{re.escape(separator)})"


def _without_quoted(line: Column, separator: str) -> Column:
    """``line`` without its closed quoted cells; a quote opens a cell only where the cell begins."""
    return F.regexp_replace(line, _at_cell_start(separator) + '"(?:[^"]++|"")*+"', "$1")


def leaves_open(line: Column, separator: str) -> Column:
    """Whether a quoted cell is open after ``line``, if none was before it."""
    return F.contains(line, F.lit('"')) & _without_quoted(line, separator).rlike(_at_cell_start(separator) + '"')


def _by_separator(line: Column) -> Column:
    """:func:`leaves_open` for the ``separator`` of the line's file."""
    out = F.lit(False)
    for separator in SEPARATORS:
        out = F.when(F.col("separator") == separator, leaves_open(line, separator)).otherwise(out)
    return out


def count_cells(record: Column, separator: str) -> Column:
    """How many cells a record has; one that is never closed goes to its end."""
    bare = F.regexp_replace(_without_quoted(record, separator), _at_cell_start(separator) + '"[\\s\\S]*$', "$1")
    return F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(separator), F.lit(""))) + 1


def _state_before(lines: DataFrame) -> DataFrame:
    """``lines`` (with ``fresh`` and ``going``: the state after a line from either state) with ``open``, the state before."""
    order = W.partitionBy("file", "block").orderBy(LINE)
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    # a line keeps the state, turns it over, or sets it whatever it was
    fixed = F.when(F.col("fresh") == F.col("going"), F.col("fresh"))
    turns = F.when(F.col("fresh") & ~F.col("going"), 1).otherwise(0)
    marked = lines.withColumn("turns", F.coalesce(F.sum(turns).over(earlier), F.lit(0)))
    # the last line that sets the state, with the turns up to it
    known = F.last(F.when(fixed.isNotNull(), F.struct(fixed.alias("state"), F.col("turns").alias("turns"))), ignorenulls=True).over(earlier)
    marked = marked.withColumn("known", known)

    # the same over splits: what a split does to the state that enters it
    last = F.max_by(F.struct("known", "turns", "fresh", "going"), LINE).alias("l")
    ends = marked.groupBy("file", "block").agg(last).select("file", "block", "l.*")
    set_by = F.when(F.col("fresh") == F.col("going"), F.col("fresh"))
    own_turn = F.when(F.col("fresh") & ~F.col("going"), 1).otherwise(0)
    through = F.when(F.col("known").isNotNull(), _turned(F.col("known.state"), F.col("turns") - F.col("known.turns") + own_turn))
    ends = ends.select("file", "block", F.coalesce(set_by, through).alias("sets"), (F.col("turns") + own_turn).alias("turns"))
    blocks = W.partitionBy("file").orderBy("block")
    before = blocks.rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("all_turns", F.sum("turns").over(blocks))
    source = F.last(F.when(F.col("sets").isNotNull(), F.struct("sets", "all_turns")), ignorenulls=True).over(before)
    so_far = F.coalesce(F.sum("turns").over(before), F.lit(0))
    entering = F.when(source.isNull(), _turned(F.lit(False), so_far)).otherwise(_turned(source["sets"], so_far - source["all_turns"]))
    entries = ends.select("file", "block", entering.alias("entering"))

    joined = marked.join(F.broadcast(entries), ["file", "block"])
    inside = F.when(F.col("known").isNull(), _turned(F.col("entering"), F.col("turns"))).otherwise(
        _turned(F.col("known.state"), F.col("turns") - F.col("known.turns"))
    )
    return joined.withColumn("open", inside).drop("turns", "known", "entering")


def _turned(state: Column, times: Column) -> Column:
    return state != (times % 2 == 1)


def frame_records(lines: DataFrame) -> DataFrame:
    """``(file, line_id, value, lines)``: one row per record, ``line_id`` of its first line.

    ``lines`` come with text in ``value`` and the ``separator`` of their file.  Line ends within quotes are
    kept.  In a file whose last quote is never closed every line is a record, so one stray quote does
    not swallow the rest of a file.
    """
    plain = ["file", LINE, "value", F.lit(1).cast("bigint").alias("lines")]
    fresh = _by_separator(F.col("value"))
    torn = stage(lines.groupBy("file").agg(F.max(fresh).alias("torn")).filter("torn").select("file"), "torn-files")
    if torn.isEmpty():
        return lines.select(*plain)
    torn = F.broadcast(torn)
    # files without an open line are records as they are, and are not shuffled
    whole = lines.join(torn, "file", "left_anti").select(*plain)
    described = lines.join(torn, "file", "left_semi").withColumns({"fresh": fresh, "going": _by_separator(F.concat(F.lit('"'), "value"))})
    states = stage(_state_before(described), "states")
    after = F.when(F.col("open"), F.col("going")).otherwise(F.col("fresh"))
    broken = F.broadcast(states.groupBy("file").agg(F.max_by(after, LINE).alias("broken")).filter("broken").select("file"))
    unclosed = states.join(broken, "file", "left_semi").select(*plain)
    framed = states.join(broken, "file", "left_anti").withColumn("after", after)
    single = framed.filter("not open and not after").select(*plain)

    # lines of records that go on: the first line is the last one that was not open, in this split or before
    pieces = framed.filter("open or after")
    order = W.partitionBy("file", "block").orderBy(LINE)
    first = F.last(F.when(~F.col("open"), F.col(LINE)), ignorenulls=True).over(order)
    pieces = pieces.withColumn("first", first)
    ends = pieces.groupBy("file", "block").agg(F.max_by("first", LINE).alias("first"))
    carried = F.last("first", ignorenulls=True).over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    carried = ends.select("file", "block", carried.alias("carried"))
    pieces = pieces.join(F.broadcast(carried), ["file", "block"]).withColumn("first", F.coalesce("first", "carried"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(LINE, "value"))), lambda p: p["value"]), "\n")
    joined = pieces.groupBy("file", F.col("first").alias(LINE)).agg(text.alias("value"), F.count(F.lit(1)).alias("lines"))
    return whole.unionByName(unclosed).unionByName(single).unionByName(joined)
