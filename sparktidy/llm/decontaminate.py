"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A fixed mask looks at some of a few consecutive words and ignores the others.  Every position of every
benchmark item and of every document is hashed under each mask; equal hashes place item and document
on a diagonal, and each diagonal is verified word by word: an item leaks into a document if, without
gaps, some ``window`` (16) consecutive words of it agree in at least ``share`` (0.8) of the positions.
Items shorter than the window must agree as a whole: entirely, as fewer words are weaker evidence.
Items of fewer than five words are no evidence and are not looked for.

The masks ``11111`` and ``1101011`` together hit every window of 16 words with up to three
substitutions (all 560 placements are tested), so the search loses no leak by this definition.

A word is a run of ASCII letters, digits and non-ASCII characters of the lower-cased text.  Null and
empty texts have no words.  Repeated rows are reported once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._frames import bounded
from sparktidy.workspace import stage

MASKS = ("11111", "1101011")
WINDOW = 16
SHARE = 0.8
_BETWEEN_WORDS = "[^0-9a-z\\x{80}-\\x{10FFFF}]+"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once: a name inside a lambda would evaluate it for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN_WORDS), "")


def _positions(df: DataFrame, text: str, keep: list[str], position: str) -> DataFrame:
    """One row per mask and position: ``keep``, ``position``, ``seed``.

    The words are zipped with themselves, each time shifted by one, so that one generated row holds a
    whole window and both masks are hashed in compiled code rather than in a lambda.
    """
    span = max(map(len, MASKS))
    listed = df.select(*keep, words_of(F.col(text)).alias("w0"))
    shifted = [F.slice("w0", k + 1, F.size("w0")) for k in range(1, span)]
    rows = listed.select(*keep, F.posexplode(F.arrays_zip("w0", *shifted)).alias(position, "w"))
    word = [F.col("w.w0"), *(F.col(f"w.`{k}`") for k in range(1, span))]
    # past the last word there are nulls, which a hash would skip over
    seeds = [
        F.when(word[len(mask) - 1].isNotNull(), F.xxhash64(F.lit(n), *[word[k] for k, c in enumerate(mask) if c == "1"]))
        for n, mask in enumerate(MASKS)
    ]
    return rows.select(*keep, position, F.explode(F.array(*seeds)).alias("seed")).filter("seed is not null")


def _agreement(doc: Column, item: Column, diagonal: Column) -> Column:
    """1 for each word of the item that equals the document's word on the diagonal."""
    return F.transform(
        item,
        lambda x, j: F.when((j + diagonal >= 0) & (j + diagonal < F.size(doc)) & (F.get(doc, F.greatest(j + diagonal, F.lit(0))) == x), 1).otherwise(0),
    )


def _best_window(agreement: Column) -> Column:
    """``(matched, begin)`` of the best window, the first one on a tie."""
    size = F.least(F.size(agreement), F.lit(WINDOW))
    windows = F.transform(
        F.sequence(F.lit(0), F.size(agreement) - size),
        lambda s: F.struct(F.aggregate(F.slice(agreement, s + 1, size), F.lit(0), lambda a, b: a + b).alias("matched"), (-s).alias("begin")),
    )
    return F.array_max(windows)


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(doc_id, item_id, item_words, matched, window, begin)``: each leaked item once per document.

    ``matched`` of ``window`` words agree; ``begin`` is the word of the document at which they start.
    """
    found = _leaks(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), items, item_id, text)
    found = found.groupBy("doc_id", "item_id").agg(
        F.max("item_words").alias("item_words"),
        F.max(F.struct(F.col("best.matched").alias("matched"), (F.col("best.begin") - F.col("diagonal")).alias("begin"))).alias("best"),
    )
    return found.select("doc_id", "item_id", "item_words", "best.matched", F.least("item_words", F.lit(WINDOW)).alias("window"), (-F.col("best.begin")).alias("begin"))


def _leaks(docs: DataFrame, items: DataFrame, item_id: str, text: str) -> DataFrame:
    """The leaking diagonals; ``copy``, the hash of the text, tells apart the rows of one id or without one."""
    known = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).withColumn("item", words_of(F.col("text"))).filter(F.size("item") >= len(MASKS[0])).distinct()
    wanted = _positions(known, "text", ["item_id"], "item_at")
    known = known.drop("text")
    places = _positions(docs.select("doc_id", F.xxhash64("text").alias("copy"), "text"), "text", ["doc_id", "copy"], "doc_at")
    hits = places.join(bounded(wanted), "seed").select("doc_id", "copy", "item_id", (F.col("doc_at") - F.col("item_at")).alias("diagonal")).distinct()
    hits = stage(hits, "hits").toDF("hit_id", "hit_copy", "item_id", "diagonal")
    hits = bounded(hits.join(bounded(known), "item_id"))
    texts = docs.withColumn("copy", F.xxhash64("text"))
    met = texts.join(hits, texts.doc_id.eqNullSafe(hits.hit_id) & (texts.copy == hits.hit_copy))
    agreement = _let(words_of(F.col("text")), lambda words: _agreement(words, F.col("item"), F.col("diagonal")))
    best = met.select("doc_id", "copy", "item_id", F.size("item").alias("item_words"), "diagonal", _let(agreement, _best_window).alias("best"))
    window = F.least("item_words", F.lit(WINDOW))
    enough = F.when(F.col("item_words") < WINDOW, F.col("best.matched") == F.col("item_words")).otherwise(F.col("best.matched") >= F.ceil(window * F.lit(SHARE)))
    return best.filter(enough)


def drop_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows into whose text an item leaked; the others and all columns stay as they are."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    leaked = bounded(_leaks(plain, items, item_id, text).select(F.col("doc_id").alias("__leaked"), F.col("copy").alias("__copy")).distinct())
    return docs.join(leaked, docs[doc_id].eqNullSafe(F.col("__leaked")) & (F.xxhash64(docs[text]) == F.col("__copy")), "left_anti")
