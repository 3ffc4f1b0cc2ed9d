"""Mixed date notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktidy.functions.rule import Rule, only_if, reuses_input
from sparktidy.functions.text import clean_text

_CLOCK = "[ T][0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?$"
_YEAR_FIRST = "^(?!0000)[0-9]{4}([-/])[0-9]{1,2}\\1[0-9]{1,2}$"
_DAY_FIRST = "^[0-9]{1,2}[./-][0-9]{1,2}[./-](?:(?!0000)[0-9]{4}|[0-9]{2})$"
_DAY_MONTH = "^([0-9]{1,2})[./-]([0-9]{1,2})[./-]"
_SERIAL = "^([0-9]{5})(?:\\.0)?$"


def _year_first(value: Column) -> Column:
    """Day-first notation to year-month-day."""
    value = F.regexp_replace(value, f"{_DAY_MONTH}([0-9]{{4}})$", "$3-$2-$1")
    value = F.regexp_replace(value, f"{_DAY_MONTH}(69|[7-9][0-9])$", "19$3-$2-$1")
    return F.regexp_replace(value, f"{_DAY_MONTH}([0-9]{{2}})$", "20$3-$2-$1")


@reuses_input
def _to_date(value: Column) -> Column:
    # the notations exclude one another; coalesce tries the next one only where one gave nothing
    year_first = F.replace(only_if(value, _YEAR_FIRST), F.lit("/"), F.lit("-"))
    day_first = _year_first(only_if(value, _DAY_FIRST))
    serial = only_if(value, _SERIAL, 1).try_cast("int")
    return F.coalesce(
        year_first.try_cast("date"),
        day_first.try_cast("date"),
        F.date_add(F.lit("1899-12-30").cast("date"), serial),
    )


# ISO, day-first with any of . / -, two-digit years (69-99 are 19xx) and spreadsheet serials
parse_mixed_dates = Rule(
    "parse_mixed_dates",
    clean_text,
    lambda v: F.regexp_replace(v, _CLOCK, ""),
    _to_date,
)


def month_bucket(day: Column | str) -> Column:
    """``YYYY-MM``"""
    return F.date_format(day, "yyyy-MM")
