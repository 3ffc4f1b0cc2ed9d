"""Text renderings used by sinks and summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# thousands separator, decimal mark
LOCALES = {"en": (",", "."), "pl": (" ", ",")}


def format_amount(value: Column, locale: str = "pl", digits: int = 2) -> Column:
    """``1234.5`` -> ``1 234,50`` (pl) or ``1,234.50`` (en)."""
    thousands, mark = LOCALES[locale]
    return F.translate(F.format_number(value, digits), ",.", thousands + mark)


def format_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def decimal_comma(value: Column) -> Column:
    """A number as text with a decimal comma and no thousands separator."""
    return F.translate(value.cast("string"), ".", ",")


def plain_text(value: Column, data_type: str) -> Column:
    """A typed value as the text a spreadsheet shows: no exponent, no ``.0`` on whole numbers."""
    if data_type in ("float", "double"):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        return F.when(whole, value.try_cast("bigint").cast("string")).otherwise(value.cast("string"))
    return value.cast("string")
