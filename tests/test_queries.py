"""Registered queries against DuckDB on the smallest tables; ``verification.compare`` runs them all."""

import os

import pytest

import __spark_entry__ as entry_points
from verification import compare, oracles, queries

SMALL = "/root/testdata/sf0.001"
CHOSEN = [
    "clean_text", "normalize_key", "normalize_email", "normalize_skus", "parse_number", "parse_dates", "format_locale",
    "drop_blank_rows", "dedup_exact", "dedup_keep_first", "link_records", "golden_record", "merged_ids", "change_log",
    "pivot_with_totals", "sales_log", "sample_per_branch", "ingest_encoding_profile", "ingest_mixed_csv", "ingest_rejects", "sales_job_from_files", "customers_from_files", "locale_csv",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return compare.duck(SMALL)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_oracle(spark, connection, name):
    outcome = compare.compare(spark, connection, SMALL, entry_points.queries()[name], entry_points.oracle_sql()[name])
    assert outcome.startswith("ok")


def test_every_query_has_an_oracle():
    assert set(queries.QUERIES) == set(oracles.ORACLES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 120
