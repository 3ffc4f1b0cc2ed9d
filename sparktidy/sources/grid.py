"""Tables whose header is not in the first row: titles and blank rows above it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktidy.sources.delimited import SOURCE_FILE, cells_of, csv_options, decoded, missing_to_null, unique_names
from sparktidy.sources.profile import profile_grids
from sparktidy.sources.records import LINE, frame_records, numbered_lines
from sparktidy.workspace import stage

ROW_NO = "row_no"


def cell_columns(grid: DataFrame) -> list[str]:
    return [c for c in grid.columns if c not in (SOURCE_FILE, ROW_NO)]


def _best_rows(grid: DataFrame) -> DataFrame:
    """Per file the first row with the largest number of filled cells, whole, and how wide the file is.

    One aggregate that carries the cells of the best row so far, combined before the shuffle.
    """
    cells = cell_columns(grid)
    filled = reduce(lambda a, c: a + F.col(c).isNotNull().cast("int"), cells, F.lit(0))
    width = F.greatest(F.lit(0), *[F.when(F.col(c).isNotNull(), i + 1).otherwise(0) for i, c in enumerate(cells)])
    row = F.struct((-filled).alias("less"), F.col(ROW_NO).alias("header_row"), F.array(*cells).alias("cells"))
    return grid.groupBy(SOURCE_FILE).agg(F.min(row).alias("best"), F.max(width).alias("width"))


def detect_header_row(grid: DataFrame) -> DataFrame:
    """``(source_file, header_row, <cells of that row, trimmed>)``, one row per file."""
    cells = [F.trim(F.col("best.cells")[i]).alias(c) for i, c in enumerate(cell_columns(grid))]
    return _best_rows(grid).select(SOURCE_FILE, F.col("best.header_row").alias("header_row"), *cells)


def split_grid(grid: DataFrame) -> list[DataFrame]:
    """One table per distinct header: the rows below it, without fully empty ones.

    Columns without a name that hold anything are ``_c<position>``.  The distinct headers come to the
    driver, not the files; where the header of a file is, one row per file, is broadcast.
    """
    cells = cell_columns(grid)
    found = _best_rows(grid).select(SOURCE_FILE, "width", F.col("best.header_row").alias("header_row"), F.transform("best.cells", lambda c: F.trim(c)).alias("header"))
    found = stage(found, "headers")
    tables = []
    for kind in found.groupBy("header").agg(F.max("width").alias("width"), F.min(SOURCE_FILE).alias("first")).orderBy("first").collect():
        header = [name if name or i < kind.width else None for i, name in enumerate(kind.header)]
        used = [(c, i) for i, c in enumerate(cells) if header[i] or i < kind.width]
        names = unique_names([header[i] for _, i in used], [SOURCE_FILE, ROW_NO])
        names = [f"_c{i}" if not header[i] else name for name, (_, i) in zip(names, used)]
        same = reduce(and_, [F.col("header")[i].eqNullSafe(F.lit(name)) for i, name in enumerate(kind.header)], F.lit(True))
        starts = found.filter(same).select(SOURCE_FILE, "header_row")
        below = grid.join(F.broadcast(starts), SOURCE_FILE).filter(F.col(ROW_NO) > F.col("header_row"))
        tables.append(below.dropna(how="all", subset=cells).select(*[F.col(c).alias(name) for (c, _), name in zip(used, names)], SOURCE_FILE, ROW_NO))
    return tables


def read_grid_smart(spark: SparkSession, paths: Sequence[str] | str) -> list[DataFrame]:
    """Number the lines, profile the files, read them as cells and split off the headers.

    Cells may go over several lines within quotes.  ``row_no`` is the number of a row's first line over all
    files, in the order of their names.
    """
    lines = numbered_lines(spark, paths)
    profile = stage(profile_grids(lines.withColumn("value", F.col("value").cast("string"))), "grids")
    marked = lines.join(F.broadcast(profile.select("file", "separator")), "file").withColumn("value", F.decode("value", "ISO-8859-1"))
    records = stage(frame_records(marked).filter(F.trim("value") != ""), "records")
    tables = []
    formats = profile.groupBy("encoding", "separator", "fields").agg(F.min("file").alias("first")).orderBy("first").collect()
    for kind in formats:
        same = (F.col("encoding") == kind.encoding) & (F.col("separator") == kind.separator) & (F.col("fields") == kind.fields)
        own = records.join(F.broadcast(profile.filter(same).select("file")), "file")
        cells = [f"c{i}" for i in range(kind.fields)]
        record = decoded(F.encode("value", "ISO-8859-1"), kind.encoding)
        parsed = own.select("file", LINE, cells_of(record, cells, csv_options(kind.separator)))
        grid = parsed.select(F.col("file").alias(SOURCE_FILE), F.col(LINE).alias(ROW_NO), *[missing_to_null(F.col(c)).alias(c) for c in cells])
        tables.extend(split_grid(grid))
    return tables
