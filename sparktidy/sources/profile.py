"""What each input file looks like: encoding, separator, header line.

One distributed pass over the raw lines of all files; nothing but one row per file reaches the
driver, which has to know the file list anyway.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = (",", ";", "\t")

# single-byte code pages in the order they are tried after UTF-8
CODE_PAGES = {"windows-1250": "cp1250", "iso-8859-2": "iso8859_2"}


def _undefined_bytes(codec: str) -> list[int]:
    return [b for b in range(256) if bytes([b]).decode(codec, errors="ignore") == ""]


def raw_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """``(value, file, block, seq)``; ``value`` keeps the raw bytes, ``(block, seq)`` is file order."""
    return spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def readable_path(uri: str) -> str:
    """A file's URI as a path the reader takes: decoded, with the characters of name patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _byte_class(value: Column) -> Column:
    """0 any, 1 only UTF-8, 2 only windows-1250, 3 neither of them."""
    raw = value.cast("binary")
    undefined = F.lit(False)
    for byte in _undefined_bytes("cp1250"):
        undefined = undefined | F.contains(raw, F.unhex(F.lit(f"{byte:02X}")))
    return F.when(F.is_valid_utf8(value), 0).otherwise(2) + undefined.cast("int")


def _encoding(classes: Column) -> Column:
    def seen(code: int) -> Column:
        return F.array_contains(classes, code)

    return (
        F.when(~seen(2) & ~seen(3), "utf-8")
        .when(~seen(1) & ~seen(3), "windows-1250")
        .otherwise("iso-8859-2")
    )


def hashed(aggregate: Column) -> Column:
    """``aggregate`` beside a set that no pruning of columns takes from it.

    A text alone, as that of ``min_by``, would make Spark sort all lines of a task by file; with the set it keeps one
    entry for each file.
    """
    return F.when(F.size(F.collect_set(F.lit(True))) > 0, aggregate)


def count_separator(value: Column, separator: str) -> Column:
    """Occurrences outside quotes."""
    bare = F.regexp_replace(value, '"[^"]*"', "")
    return F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(separator), F.lit("")))


def choose_separator(counts: dict[str, Column]) -> Column:
    """The most frequent candidate, the first one on a tie."""
    best = F.greatest(*counts.values())
    chosen = F.lit(None).cast("string")
    for separator in reversed(list(counts)):
        chosen = F.when(counts[separator] == best, F.lit(separator)).otherwise(chosen)
    return chosen


def profile_files(lines: DataFrame) -> DataFrame:
    """``(file, encoding, separator, header, lines, fields)`` from :func:`raw_lines`.

    The encoding is the first of UTF-8, windows-1250, iso-8859-2 that can decode every line; the
    last one decodes anything and is the fallback.  ``header`` is the first line with any text.
    """
    order = F.when(F.trim("value") != "", F.struct("block", "seq"))
    per_file = lines.groupBy("file").agg(
        F.collect_set(_byte_class(F.col("value"))).alias("classes"),
        hashed(F.min_by("value", order)).alias("header"),
        F.count(F.lit(1)).alias("lines"),
    )
    counts = {s: count_separator(F.col("header"), s) for s in SEPARATORS}
    return per_file.select(
        "file",
        _encoding(F.col("classes")).alias("encoding"),
        choose_separator(counts).alias("separator"),
        "header",
        "lines",
        (F.greatest(*counts.values()) + 1).alias("fields"),
    )


def profile_grids(lines: DataFrame) -> DataFrame:
    """``(file, encoding, separator, fields)`` for files whose header may sit anywhere: the widest line decides.

    One aggregate over all lines.
    """
    seen = lines.groupBy("file").agg(
        F.collect_set(_byte_class(F.col("value"))).alias("classes"),
        *[F.max(count_separator(F.col("value"), s)).alias(f"n{i}") for i, s in enumerate(SEPARATORS)],
    )
    counts = {s: F.col(f"n{i}") for i, s in enumerate(SEPARATORS)}
    return seen.select(
        "file",
        _encoding(F.col("classes")).alias("encoding"),
        choose_separator(counts).alias("separator"),
        (F.greatest(*counts.values()) + 1).cast("int").alias("fields"),
    )
