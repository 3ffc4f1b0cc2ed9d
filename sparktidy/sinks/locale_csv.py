"""Delimited output that a local spreadsheet opens as it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.functions.render import decimal_comma, format_date
from sparktidy.operators.columns import quoted

BOM = "﻿"


def _shortest(value: Column) -> Column:
    """The fewest digits that give the double back; the JVM itself may print one or two more."""
    text = value.cast("string")
    found = text
    for digits in (16, 15):
        trial = F.format_string(f"%.{digits - 1}E", value)
        found = F.when(trial.try_cast("double") == value, trial).otherwise(found)
    return F.when(F.length(text) <= 16, text).otherwise(found)


def _float_text(value: Column) -> Column:
    """The shortest text of a double, exactly, without exponent: its digits around a moved point."""
    short = _shortest(value)
    sign = F.when(F.startswith(short, F.lit("-")), "-").otherwise("")
    whole = F.regexp_extract(short, r"^-?([0-9]+)\.", 1)
    digits = F.concat(whole, F.regexp_extract(short, r"\.([0-9]+?)0*(?:E|$)", 1))
    exponent = F.regexp_extract(short, r"E[+]?(-?[0-9]+)$", 1).try_cast("int")
    point, n = F.length(whole) + exponent, F.length(digits)
    zero = F.lit("0")
    moved = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(zero, -point), digits))
        .when(point >= n, F.concat(digits, F.repeat(zero, point - n), F.lit(".0")))
        .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n)))
    )
    return F.when(F.contains(short, F.lit("E")), F.concat(sign, moved)).otherwise(short)


def render_locale(df: DataFrame) -> DataFrame:
    """All columns as text: ISO dates, decimal comma."""
    rendered = []
    for name, kind in df.dtypes:
        value = F.col(quoted(name))
        if kind.startswith("decimal"):
            value = decimal_comma(value)
        elif kind in ("double", "float"):
            value = F.translate(_float_text(value), ".", ",")
        elif kind in ("date", "timestamp"):
            value = format_date(value)
        else:
            value = value.cast("string")
        rendered.append(value.alias(name))
    return df.select(*rendered)


def write_locale_csv(df: DataFrame, path: str, separator: str = ";") -> None:
    """Header and byte-order mark in every part file, so that each opens on its own."""
    text = render_locale(df)
    first = text.columns[0]
    text.withColumnRenamed(first, BOM + first).write.option("sep", separator).option(
        "header", True
    ).option("escape", '"').options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_locale_csv(spark, path: str, separator: str = ";") -> DataFrame:
    """Read :func:`write_locale_csv` output back as text."""
    return spark.read.csv(path, header=True, sep=separator, quote='"', escape='"', multiLine=True)
