"""Reading many delimited files of mixed encodings, separators and headers as text."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktidy import rulepack
from sparktidy.operators.columns import quoted
from sparktidy.operators.numbering import number_rows as dense_numbers
from sparktidy.sources.profile import CODE_PAGES, hashed, profile_files
from sparktidy.sources.records import LINE, count_cells, frame_records, numbered_lines
from sparktidy.workspace import stage

ROW_ID = "row_id"
SOURCE_FILE = "source_file"


def _upper_half(encoding: str) -> str:
    """Characters of the bytes 0x80-0xFF; undefined bytes become the replacement character."""
    return bytes(range(0x80, 0x100)).decode(CODE_PAGES[encoding], errors="replace")


def recode(value: Column, encoding: str) -> Column:
    """Text read byte for byte as Latin-1 -> the text in its real single-byte code page."""
    latin = "".join(map(chr, range(0x80, 0x100)))
    return F.when(
        value.rlike("[^\\x00-\\x7f]"), F.translate(value, latin, _upper_half(encoding))
    ).otherwise(value)


def missing_to_null(value: Column, words: Sequence[str] = rulepack.CSV_MISSING) -> Column:
    return F.when(~value.isin(list(words)), value)


def unique_names(cells: Sequence[str | None], taken: Sequence[str] = ()) -> list[str]:
    """Header cells as column names, as they stand there.

    A name that occurs again, or is ``taken``, gets ``.1``, ``.2``; an empty cell is ``_c<position>``.
    """
    used, seen = {*taken}, Counter(taken)
    out = []
    for i, cell in enumerate(cells):
        name = stem = cell or f"_c{i}"
        while name in used:
            name, seen[stem] = f"{stem}.{max(seen[stem], 1)}", seen[stem] + 1
        used.add(name)
        seen[stem] = max(seen[stem], 1)
        out.append(name)
    return out


def header_names(line: str, separator: str, taken: Sequence[str] = ()) -> list[str]:
    """:func:`unique_names` of a header record."""
    return unique_names(next(csv.reader([line], delimiter=separator), []), taken)


@dataclass
class CsvFiles:
    """Delimited files as tables.

    ``tables`` has one table per distinct (encoding, separator, header record); ``rejects`` the records
    that do not fit their header: ``file``, ``row_id``, ``record``, ``cells``, ``columns``, ``reason`` (``surplus``,
    ``short`` or ``quotes`` if they are broken) and ``kept``; ``profile`` one row per file, also per empty one.
    """

    tables: list[DataFrame]
    rejects: DataFrame
    profile: DataFrame


def list_files(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """``(file)`` of all files, empty ones as well, from the list that a scan holds anyway."""
    names = spark.read.text(paths if isinstance(paths, str) else list(paths)).inputFiles()
    # written like the paths of a scan's metadata
    return spark.createDataFrame([(re.sub("^file:///", "file:/", n),) for n in names], "file string")


def decoded(value: Column, encoding: str) -> Column:
    """Bytes of a line as text; a national code page goes by way of Latin-1, byte for byte."""
    if encoding not in CODE_PAGES:
        return value.cast("string")
    return recode(F.decode(value.cast("binary"), "ISO-8859-1"), encoding)


def csv_options(separator: str) -> dict[str, str]:
    return {"sep": separator, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def cells_of(record: Column, names: Sequence[str], options: dict[str, str]) -> Column:
    """Generator of the cells of a record, as text columns ``names``.

    Catalyst moves a filter neither into nor below a generator, so each record is parsed once, and only by the
    format of its own file; as a plain expression the parser would be copied into every filter on a cell and
    moved with it below the join with the files, where it meets the records of all formats.
    """
    return F.inline(F.array(F.from_csv(record, ", ".join(f"{name} string" for name in names), options)))


def read_csv_files(spark: SparkSession, paths: Sequence[str] | str, row_id: str = ROW_ID, keep_short: bool = True) -> CsvFiles:
    """Read delimited files of any encoding and header, record by record.

    Records may go over several lines within quotes.  A record with more cells than its header is a
    reject.  One with fewer is read with nulls, as readers usually do, and listed; without ``keep_short``
    it is a reject, too.  ``row_id`` is the number of a record's first line over all files, in the order
    of their names: unique over all tables, and the same whenever the same files are read.
    """
    lines = numbered_lines(spark, paths)
    text = lines.select(F.col("value").cast("string").alias("value"), "file", "block", F.col(LINE).alias("seq"))
    found = stage(profile_files(text), "profile")
    # a file of another encoding has other bytes, but the same quotes and separators
    marked = lines.join(F.broadcast(found.select("file", "separator")), "file").withColumn("value", F.decode("value", "ISO-8859-1"))
    records = stage(frame_records(marked).filter(F.trim("value") != ""), "records")
    heads = records.groupBy("file").agg(F.min(LINE).alias("head"), hashed(F.min_by("value", LINE)).alias("header_record"))
    files = stage(found.join(heads, "file"), "files")

    tables, rejects = [], []
    # the formats come to the driver, not the files
    formats = files.groupBy("encoding", "separator", "header_record").agg(F.min("file").alias("first")).orderBy("first").collect()
    for kind in formats:
        raw = kind.header_record.encode("latin-1")
        header = raw.decode(CODE_PAGES.get(kind.encoding, "utf-8"), errors="replace").removeprefix("\ufeff")
        names = header_names(header, kind.separator, [SOURCE_FILE, row_id])
        same = (F.col("encoding") == kind.encoding) & (F.col("separator") == kind.separator) & (F.col("header_record") == kind.header_record)
        own = records.join(F.broadcast(files.filter(same).select("file", "head")), "file").filter(F.col(LINE) > F.col("head"))
        record = F.encode("value", "ISO-8859-1")
        own = own.select("file", LINE, decoded(record, kind.encoding).alias("record"))
        cells = [f"c{i}" for i in range(len(names))]
        options = {**csv_options(kind.separator), "columnNameOfCorruptRecord": "odd"}
        parsed = own.select("file", LINE, "record", cells_of(F.col("record"), [*cells, "odd"], options))
        count = count_cells(F.col("record"), kind.separator)
        odd = parsed.filter("odd is not null").select(
            "file", F.col(LINE).alias(row_id), "record", count.cast("bigint").alias("cells"), F.lit(len(names)).cast("bigint").alias("columns"),
            F.when(count > len(names), "surplus").when(count < len(names), "short").otherwise("quotes").alias("reason"),
        )
        rejects.append(odd.withColumn("kept", (F.col("reason") == "short") & F.lit(keep_short)))
        fits = F.col("odd").isNull() | ((count < len(names)) & F.lit(keep_short))
        values = [missing_to_null(F.col(c)).alias(name) for c, name in zip(cells, names)]
        tables.append(parsed.filter(fits).select(*values, F.col("file").alias(SOURCE_FILE), F.col(LINE).alias(row_id)))
    nothing = spark.createDataFrame([], f"file string, {row_id} bigint, record string, cells bigint, columns bigint, reason string, kept boolean")
    listed = list_files(spark, paths).join(found, "file", "left").withColumn("lines", F.coalesce("lines", F.lit(0).cast("bigint")))
    return CsvFiles(tables, reduce(DataFrame.unionByName, rejects, nothing), listed.select(*found.columns))


def read_csv_smart(spark: SparkSession, paths: Sequence[str] | str) -> tuple[list[DataFrame], DataFrame]:
    """``(tables, profile)`` of :func:`read_csv_files`, the tables without row numbers.

    The tables still have their own headers; map them with ``standardize_columns`` before appending.
    """
    files = read_csv_files(spark, paths, row_id="__row")
    return [t.drop("__row") for t in files.tables], files.profile


def append_tables(tables: Sequence[DataFrame], order: Sequence[str] = (SOURCE_FILE,)) -> DataFrame:
    """Append tables by column name and number the rows from 0: by ``order``, then by all columns.

    The numbers are dense and unique over all tables, and the same whenever the same rows come.
    """
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    rest = [c for c in joined.columns if c not in order]
    return dense_numbers(joined, [F.col(quoted(c)) for c in [*[o for o in order if o in joined.columns], *rest]], ROW_ID, 0)


def number_rows(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Row numbers of a table read from Parquet, in file order: dense from 0 over all its files.

    A file's own row index is shifted by the rows of the files before it (one row per file); files go
    by name, so part files keep the order in which they were written.
    """
    if len(df.inputFiles()) == 1:
        return df.select("*", F.col("_metadata.row_index").alias(name))
    placed = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    sizes = df.select(F.col("_metadata.file_path").alias("__file")).groupBy("__file").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__file", F.coalesce(before, F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(offsets), "__file").withColumn(name, F.col("__at") + F.col("__before")).drop("__file", "__at", "__before")


def spread_scan(df: DataFrame, *keys: str) -> DataFrame:
    """Distribute a plain scan over all cores if it has fewer splits than there are cores.

    Rules are CPU-bound, and a file with a single row group is a single task however many cores are
    idle.  A scan that already has enough splits, like any large input, is returned as it is.  Hashing
    by ``keys`` keeps the distribution the same when a lost task is repeated.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
