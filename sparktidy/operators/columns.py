"""Header mapping, optional columns, blank rows, appending sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.functions.render import plain_text
from sparktidy.functions.text import header_key, is_nothing


class MissingColumnsError(KeyError):
    """A canonical column has no matching header."""


class AmbiguousColumnsError(ValueError):
    """Two headers claim the same canonical column."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def as_text(df: DataFrame, except_for: Sequence[str] = ()) -> DataFrame:
    """Every column as text, the way an all-text reader would deliver it."""
    return df.select(
        *[
            F.col(quoted(name))
            if kind == "string" or name in except_for
            else plain_text(F.col(quoted(name)), kind).alias(name)
            for name, kind in df.dtypes
        ]
    )


def match_headers(columns: Sequence[str], synonyms: Mapping[str, Iterable[str]]) -> dict[str, str]:
    """``{canonical name: source column}``; raises before any job starts."""
    headers: dict[str, list[str]] = {}
    for name in columns:
        headers.setdefault(header_key(name), []).append(name)
    sources: dict[str, list[str]] = {}
    for canonical in reversed(list(synonyms)):  # an alias of several names goes to the last
        keys = map(header_key, (canonical, *synonyms[canonical]))
        found = [name for key in keys for name in headers.pop(key, [])]
        if found:
            sources[canonical] = found
    missing = sorted(set(synonyms) - set(sources))
    if missing:
        raise MissingColumnsError(f"no header for {missing}; the table has {list(columns)}")
    doubled = {canonical: names for canonical, names in sources.items() if len(names) > 1}
    if doubled:
        raise AmbiguousColumnsError(f"several headers for one column: {doubled}")
    return {canonical: sources[canonical][0] for canonical in synonyms}


def standardize_columns(
    df: DataFrame, synonyms: Mapping[str, Iterable[str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Rename by synonym list and project to the canonical order (after ``keep``)."""
    chosen = match_headers([c for c in df.columns if c not in keep], synonyms)
    return df.select(
        *keep, *[F.col(quoted(source)).alias(name) for name, source in chosen.items()]
    )


def with_optional_column(df: DataFrame, name: str, aliases: Iterable[str]) -> DataFrame:
    """Add ``name`` as null text unless some header already stands for it."""
    known = {header_key(a) for a in [name, *aliases]}
    if any(header_key(c) in known for c in df.columns):
        return df
    return df.withColumn(name, F.lit(None).cast("string"))


def is_blank(columns: Sequence[str]) -> Column:
    """All of ``columns`` empty or placeholders."""
    return reduce(and_, [is_nothing(F.col(quoted(c))) for c in columns])


def drop_blank_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.filter(~is_blank(columns or df.columns))


def append_sources(sources: Mapping[str, DataFrame], source_column: str) -> DataFrame:
    """Tag each table with its name and append by column name."""
    tagged = [df.withColumn(source_column, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
