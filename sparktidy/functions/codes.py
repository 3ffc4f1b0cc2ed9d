"""Product-code rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktidy.functions.rule import Rule
from sparktidy.functions.text import clean_text

# PREFIX + digits becomes PREFIX-ddd: pad short numbers, drop leading zeros down to three digits
normalize_sku = Rule(
    "normalize_sku",
    clean_text,
    lambda v: F.regexp_replace(F.upper(v), "[^A-Z0-9]", ""),
    lambda v: F.regexp_replace(v, "^(?<prefix>[A-Z]+)(?<number>[0-9]{1,2})$", "${prefix}00${number}"),
    lambda v: F.regexp_replace(v, "^([A-Z]+)0*([0-9]{3,})$", "$1-$2"),
)
