"""The corpus pipeline: filtering and rewriting stages over the documents.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as
the documents of the next one.  Toxic documents go; lines that an earlier document holds are cut, and a
document of which nothing stays goes; one document of each class of near duplicates stays; documents
with a benchmark item go; the rest is encoded.  Columns, further ones included, stay as they are, but
for ``text`` and ``n_chars`` of a document that lost lines.  Rows with a null text pass all filters; those
with a null id take no part in deduplication, but a toxic or leaking one goes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktidy.llm import pieces, toxicity
from sparktidy.llm.decontaminate import drop_leaks
from sparktidy.llm.line_dedup import drop_repeated_blocks
from sparktidy.llm.near_dup import keep_one_of_each
from sparktidy.llm.queries import PIECES, toxic_training, table
from sparktidy.session import bound_batches
from sparktidy.workspace import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(step: Stage) -> Stage:
    """The step in a session whose batches for Python are bounded: executors hold those of all their tasks at once."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return step(bound_batches(spark), docs, sf_dir)

    return run


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = toxicity.labelled_rows(docs, table(spark, sf_dir, "labels"), "toxic", toxic_training())
    # the whole row in one column, as a further column may be named like a result
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("judged"))
    scored = toxicity.score_toxicity(rows, toxicity.train(labelled), text="judged", keep=["row"])
    return scored.filter("score < 0.5").select("row.*")


@in_small_batches
def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = drop_repeated_blocks(docs, "doc_id")
    cut = cut.filter(F.col("__runs").isNull() | (F.trim("text") != ""))
    return cut.withColumn("n_chars", F.when(F.col("__runs").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*docs.columns)


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, "doc_id")


@in_small_batches
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    added = ("ids", "n_pieces", "round_trip")
    rows = docs.select(*[c for c in docs.columns if c.lower() not in added])
    coded = pieces.encode(rows, pieces.load_model(PIECES), check=True)
    return coded.withColumn("n_pieces", F.size("ids")).select(*rows.columns, "ids", "n_pieces", "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", to_pieces),
]
ORACLE_SQL: str | None = None  # only the decontamination can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
