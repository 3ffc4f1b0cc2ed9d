"""Changed cells, rejects, issues, change log, rows worth showing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktidy import rulepack
from sparktidy.functions.text import clean_text


# ---- changed cells ------------------------------------------------------------------
def differs(before: Column, after: Column) -> Column:
    return ~before.eqNullSafe(after)


def count_changed(before: Column, after: Column) -> Column:
    """Aggregate: cells that a step changed; null equals null."""
    return F.count_if(differs(before, after))


def count_present(value: Column) -> Column:
    return F.count(value)


# ---- rejects ------------------------------------------------------------------------
def unreadable(required: Sequence[str]) -> Column:
    """Names of the required columns that could not be read; empty for a good row."""
    return F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])


def split_rejects(
    df: DataFrame, required: Sequence[str], reason: str = "reason"
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``; a reject says which required columns could not be read."""
    good = df.dropna(subset=list(required))
    return good, df.withColumn(reason, unreadable(required)).filter(F.col(reason) != "")


# ---- issues -------------------------------------------------------------------------
def field_issue(column: str, raw: str, label: str) -> Column:
    """Why a required field is empty: unreadable raw text, or nothing at all."""
    invalid = F.concat(F.lit(f"nieprawidłowy {label}: '"), F.col(raw), F.lit("'"))
    return F.when(F.col(column).isNull(), F.coalesce(invalid, F.lit(f"brak: {label}")))


def postal_mismatch(
    city: Column,
    code: Column,
    prefixes: Mapping[str, Sequence[str]] = rulepack.CITY_POSTAL_PREFIXES,
) -> Column:
    """True where a known city has a code with a foreign prefix; false otherwise."""
    wrong = F.lit(False)
    for name, allowed in prefixes.items():
        fits = F.lit(False)
        for prefix in allowed:
            fits = fits | code.startswith(prefix)
        wrong = F.when(city == name, ~fits).otherwise(wrong)
    return F.coalesce(wrong, F.lit(False))


def postal_issue(city: str, code: str, prefixes: Mapping[str, Sequence[str]] = rulepack.CITY_POSTAL_PREFIXES) -> Column:
    text = F.concat(F.lit("kod "), F.col(code), F.lit(" nie pasuje do miasta "), F.col(city))
    return F.when(postal_mismatch(F.col(city), F.col(code), prefixes), text)


def join_issues(issues: Sequence[Column]) -> Column:
    """One text, empty when there is nothing to check."""
    return F.concat_ws("; ", *issues)


def issue_rows(df: DataFrame, key: str, issues: Mapping[str, Column]) -> DataFrame:
    """Long form: ``(key, rule, issue)``, one row per issue."""
    listed = F.explode(
        F.array(*[F.struct(F.lit(rule).alias("rule"), text.alias("issue")) for rule, text in issues.items()])
    )
    return df.select(key, listed.alias("found")).select(key, "found.rule", "found.issue").filter(
        "issue is not null"
    )


# ---- change log ---------------------------------------------------------------------
class Step(NamedTuple):
    name: str
    category: str  # rows, removed, standardized, merged, flagged
    count: Column


def change_log(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """``(step_no, step, category, count)`` with all counts from one aggregate over ``df``."""
    totals = df.agg(*[s.count.cast("bigint").alias(f"c{i}") for i, s in enumerate(steps)])
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step_no"),
                F.lit(s.name).alias("step"),
                F.lit(s.category).alias("category"),
                F.coalesce(F.col(f"c{i}"), F.lit(0)).alias("count"),
            )
            for i, s in enumerate(steps)
        ]
    )
    return totals.select(F.inline(entries))


def step_counts(steps: Sequence[Step]) -> dict[str, Column]:
    """The counts of ``steps`` as named aggregates, to be taken while a table is written."""
    return {f"c{i}": s.count.cast("bigint") for i, s in enumerate(steps)}


def written_log(spark: SparkSession, steps: Sequence[Step], counts: Mapping[str, int | None]) -> DataFrame:
    """:func:`change_log` from counts that were taken on the way."""
    rows = [(i + 1, s.name, s.category, counts[f"c{i}"] or 0) for i, s in enumerate(steps)]
    return spark.createDataFrame(rows, "step_no int, step string, category string, count bigint")


def join_logs(logs: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    """Append ``(log, number of steps)`` pairs, numbering the steps through."""
    parts, shift = [], 0
    for log, length in logs:
        parts.append(log.withColumn("step_no", F.col("step_no") + shift))
        shift += length
    return reduce(DataFrame.unionByName, parts)


# ---- rows worth showing -------------------------------------------------------------
def messiness(columns: Sequence[str]) -> Column:
    """In how many columns the raw text differs from its cleaned text."""
    score = F.lit(0)
    for c in columns:
        raw = F.coalesce(F.col(c), F.lit(""))
        tidy = F.coalesce(clean_text(F.col(c)), F.lit(""))
        score = score + (raw != tidy).cast("int")
    return score


def messiest_rows(df: DataFrame, columns: Sequence[str], row_id: str, n: int = 6) -> DataFrame:
    scored = df.withColumn("score", messiness(columns))
    return scored.orderBy(F.desc("score"), row_id).limit(n)


def cell_changed(raw: Column, target: Column) -> Column:
    """The raw text is not literally the delivered text; null counts as empty."""
    return F.coalesce(raw, F.lit("")) != F.coalesce(target, F.lit(""))


def repaired_rows(
    df: DataFrame, changed: Mapping[str, Column], complete: Sequence[str], row_id: str, n: int = 6
) -> DataFrame:
    """The ``n`` fully repaired rows with the most changed cells.

    Adds one ``changed_<label>`` flag per entry of ``changed`` and their number as ``score``, which
    is -1 while any of the ``complete`` columns is null.
    """
    flags = {f"changed_{label}": condition for label, condition in changed.items()}
    total, whole = F.lit(0), F.lit(True)
    for flag in flags:
        total = total + F.col(flag).cast("int")
    for c in complete:
        whole = whole & F.col(c).isNotNull()
    return (
        df.withColumns(flags)
        .withColumn("score", F.when(whole, total).otherwise(-1))
        .orderBy(F.desc("score"), row_id)
        .limit(n)
    )
