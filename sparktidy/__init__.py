"""Cleaning, linking and merging messy business tables on Spark."""

from sparktidy.functions.codes import normalize_sku
from sparktidy.functions.contact import (
    normalize_email,
    normalize_phone_pl,
    normalize_postal_code_pl,
)
from sparktidy.functions.dates import month_bucket, parse_mixed_dates
from sparktidy.functions.numbers import parse_pl_number
from sparktidy.functions.rule import Rule, apply_rules
from sparktidy.functions.text import (
    clean_text,
    column_key,
    mark_whitespace,
    normalize_city,
    normalize_key,
    normalize_person_name,
    split_full_name,
    strip_accents,
)
from sparktidy.operators.columns import standardize_columns
from sparktidy.operators.dedup import dedup_exact, dedup_keep_first
from sparktidy.operators.linking import link_records
from sparktidy.operators.quality import change_log, count_changed
from sparktidy.sinks.bundle import write_report
from sparktidy.sinks.locale_csv import write_locale_csv
from sparktidy.sources.delimited import read_csv_files, read_csv_smart
from sparktidy.sources.grid import read_grid_smart

__all__ = [
    "Rule", "apply_rules", "change_log", "clean_text", "column_key", "count_changed", "dedup_exact",
    "dedup_keep_first", "link_records", "mark_whitespace", "month_bucket", "normalize_city",
    "normalize_email", "normalize_key", "normalize_person_name", "normalize_phone_pl",
    "normalize_postal_code_pl", "normalize_sku", "parse_mixed_dates", "parse_pl_number",
    "read_csv_files", "read_csv_smart", "read_grid_smart", "split_full_name", "standardize_columns", "strip_accents",
    "write_locale_csv", "write_report",
]
