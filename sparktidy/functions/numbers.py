"""Amounts: parsing, rounding, money arithmetic."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktidy import rulepack
from sparktidy.functions.rule import Rule, only_if, reuses_input
from sparktidy.functions.text import clean_text

MONEY = "decimal(18,2)"
# plain decimal notation only: a cast alone would also take '1d', '0x1p3' or 'Infinity'
_NUMBER = "^[+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


@reuses_input
def _one_decimal_point(value: Column) -> Column:
    """The right-most separator becomes the decimal point; several dots alone are thousands."""
    comma, dot, nothing = F.lit(","), F.lit("."), F.lit("")
    dots_only = F.when(value.rlike("\\..*\\."), F.replace(value, dot, nothing)).otherwise(value)
    with_commas = F.when(value.rlike(",[^.]*$"), F.translate(value, ",.", ".")).otherwise(
        F.replace(value, comma, nothing)
    )
    return F.when(F.contains(value, comma), with_commas).otherwise(dots_only)


def number_rule(currency_words: Sequence[str] = rulepack.CURRENCY_WORDS) -> Rule:
    """``'1 234,50 zł'``, ``'PLN 1.234,50'``, ``'1234.5'`` -> 1234.5; anything unreadable -> null."""
    noise = "(?iu)" + "|".join(map(re.escape, currency_words))
    return Rule(
        "parse_number",
        clean_text,
        lambda v: F.replace(F.regexp_replace(v, noise, ""), F.lit(" "), F.lit("")),
        _one_decimal_point,
        lambda v: only_if(v, _NUMBER).try_cast("double"),
    )


parse_pl_number = number_rule()

# already a number as it stands; null counts as "not a number"
is_plain_number = Rule(
    "is_plain_number",
    lambda v: F.coalesce(F.trim(v).rlike(_NUMBER), F.lit(False)),
)


def to_money(value: Column) -> Column:
    """Round a double to cents, half to even on the scaled value, and keep it as an exact decimal."""
    return (F.rint(value * 100) / 100).try_cast(MONEY)


def line_value(quantity: Column, unit_price: Column) -> Column:
    return to_money(quantity.cast("double") * unit_price)


def discount_flag(
    price: Column, list_price: Column, yes: str = rulepack.YES, no: str = rulepack.NO
) -> Column:
    """Below the list price by more than half a cent; no list price means no discount."""
    return F.when(F.coalesce(price < list_price - 0.005, F.lit(False)), yes).otherwise(no)
