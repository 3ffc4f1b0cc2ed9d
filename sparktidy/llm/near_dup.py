"""Near duplicates: DartMinHash signatures over five-word shingles, banded join, exact verification.

A text is the multiset of its five-word shingles, that is, a set weighted by counts.  Each unit of a
shingle's weight throws darts: the arrival times of a Poisson process that depends on the shingle and
the unit alone.  Every dart hits one of ``T`` coordinates, and a signature keeps the earliest dart of
each.  Darts later than a bound of about ``ln T / weight`` cannot matter, so long texts throw no more
darts than short ones; where a coordinate stays empty the bound is doubled (Christiani, 2020).  Two
signatures agree in a coordinate with probability equal to the weighted Jaccard similarity.

Bands of ``ROWS`` coordinates put texts into buckets: a pair of similarity 0.8 shares one of the 32
buckets with probability 1 - 5e-8.  Pairs are never listed within a whole bucket:

1. texts with equal shingle multisets form a class, represented by its smallest row;
2. each class is compared with the most central class that it shares a bucket with, and the pairs
   that are similar enough are merged into components;
3. buckets that still hold several components are compared across components: small ones whole,
   larger ones against hubs, of which every round takes more, until all such pairs are decided, each
   in the first bucket that its rows share.
   Pairs whose weights, parities or signature bits rule the similarity out are not looked at.

Parities: every unit of weight flips one of ``PARITIES`` bits, so two texts differ in at least as many
units as bits.  That bound is certain; it decides nearly all pairs of texts of up to some 600 words.

Similarity is verified on the whole texts.  Null texts are classes of their own; texts without words
are duplicates if the texts are equal; repeated rows share a class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._frames import bounded
from sparktidy.llm._graph import components
from sparktidy.llm._text import Words, give_back, mix, row_slices, shingles
from sparktidy.workspace import stage

SHINGLE = 5
BANDS, ROWS = 32, 4
T = BANDS * ROWS
SMALL_BUCKET = 64
GROWTH = 16  # of the hubs of a bucket from round to round
PARITIES = 512  # bits, in longs of 64
LONGS = PARITIES // 64
MISMATCHES = 32  # of 128 signature bits; at similarity 0.8 expect 12.8, and more than 32 once in ten million


OUTLINE = ["weight", "bits1", "bits2", *[f"odd{i}" for i in range(LONGS)]]  # what rules pairs out


def units_of(value: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """One hash per shingle and unit of its weight."""
    with np.errstate(over="ignore"):
        return mix(value + np.uint64(0xD6E8FEB86659FD93) * unit.astype(np.uint64), 90)


def weighted_shingles(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, shingle, unit, weight of the doc)``: one entry per unit of weight."""
    doc, value = shingles(Words(texts), n)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(fresh)
    unit = np.arange(len(doc)) - np.repeat(at, np.diff(np.append(at, len(doc))))
    return doc, value, unit, np.bincount(doc, minlength=len(texts))


def dart_signatures(doc: np.ndarray, value: np.ndarray, unit: np.ndarray, weight: np.ndarray, t: int = T) -> np.ndarray:
    """Earliest dart of each coordinate, one row of ``t`` 64-bit dart names per document (0 without shingles)."""
    n = len(weight)
    element = units_of(value, unit)
    bound = np.zeros(n)
    some = weight > 0
    bound[some] = (np.log(t) + 3) * t / weight[some]
    rank = np.full(n * t, np.inf)
    name = np.zeros(n * t, np.uint64)
    todo = some.copy()
    while todo.any():
        active = np.flatnonzero(todo[doc])
        # the darts of an element are arrivals at rate 1, each with a fresh hash
        time, state, limit = np.zeros(len(active)), element[active], bound[doc[active]]
        cells, ranks, names = [], [], []
        while len(active):
            state = mix(state, 91)
            time = time - np.log(((state >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53)
            inside = time <= limit
            active, time, state, limit = active[inside], time[inside], state[inside], limit[inside]
            dart = mix(state, 92)
            cells.append(doc[active] * t + (dart % np.uint64(t)).astype(np.int64))
            ranks.append(time)
            names.append(mix(dart, 93))
        cell, r, d = np.concatenate(cells), np.concatenate(ranks), np.concatenate(names)
        order = np.lexsort((r, cell))
        cell, r, d = cell[order], r[order], d[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        rank[cell[first]], name[cell[first]] = r[first], d[first]
        empty = np.isinf(rank.reshape(n, t)).any(axis=1)
        todo &= empty
        bound[todo] *= 2
        rank.reshape(n, t)[todo] = np.inf
    return name.reshape(n, t)


def band_hashes(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    n, t = signatures.shape
    acc = np.zeros((n, bands), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(t // bands):
            acc = acc * np.uint64(0xD6E8FEB86659FD93) + signatures[:, k :: t // bands]
        return mix(acc + np.arange(bands, dtype=np.uint64), 94)


def parities(doc: np.ndarray, element: np.ndarray, n: int, bits: int = PARITIES) -> np.ndarray:
    """Per document, whether an odd number of its elements fell on each bit, packed into longs."""
    cell = doc * bits + (mix(element, 98) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(cell, minlength=n * bits) & 1).astype(bool)
    return np.packbits(odd.reshape(n, bits), axis=1).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in row_slices(batch, "text"):
            doc, value, unit, weight = weighted_shingles(part.column("text"))
            n = len(part)
            signatures = dart_signatures(doc, value, unit, weight)
            bands = band_hashes(signatures).view(np.int64)
            bits = np.packbits((signatures & np.uint64(1)).astype(bool), axis=1).view(np.int64)
            odd = parities(doc, units_of(value, unit), n)
            with np.errstate(over="ignore"):
                marks = []
                for seed in (95, 96):
                    total = np.zeros(n, np.uint64)
                    np.add.at(total, doc, mix(value, seed))
                    marks.append(mix(total + weight.astype(np.uint64), seed).view(np.int64))
            flat = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(weight.astype(np.int64)), *map(pa.array, marks), *map(pa.array, bits.T.copy()), *map(pa.array, odd.T.copy()), flat],
                names=["row", "weight", "mark1", "mark2", *OUTLINE[1:], "bands"],
            )
    give_back()


def _similar(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text_a", 1 << 19):
                n = len(part)
                both = pa.concat_arrays([part.column("text_a"), part.column("text_b")])
                doc, value, unit, weight = weighted_shingles(both)
                element = units_of(value, unit)
                pair = doc % n
                order = np.lexsort((element, pair))
                p, e = pair[order], element[order]
                common = np.bincount(p[1:][(p[1:] == p[:-1]) & (e[1:] == e[:-1])], minlength=n)
                union = weight[:n] + weight[n:] - common
                keep = common >= least * union
                yield pa.RecordBatch.from_arrays([part.column("a").filter(pa.array(keep)), part.column("b").filter(pa.array(keep))], names=["a", "b"])
        give_back()

    return run


def verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The ``(a, b)`` whose texts have at least that weighted Jaccard similarity, counted on all shingles."""
    with_a = pairs.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    return with_b.select("a", "b", "text_a", "text_b").mapInArrow(_similar(least), "a bigint, b bigint")


def _may_be_similar(least: float, here: str = "", there: str = "hub_") -> Column:
    """Whether the outlines of two rows leave a similarity of ``least`` possible."""

    def unlike(names: list[str]) -> Column:
        return reduce(add, [F.bit_count(F.col(here + c).bitwiseXOR(F.col(there + c))).cast("bigint") for c in names])

    total = F.col(here + "weight") + F.col(there + "weight")
    lighter, heavier = F.least(here + "weight", there + "weight"), F.greatest(here + "weight", there + "weight")
    # units that are in one of two texts only: at most (1 - s) / (1 + s) of the total at similarity s
    return (lighter >= heavier * least - 1e-6) & (unlike(OUTLINE[3:]) <= total * ((1 - least) / (1 + least)) + 1e-6) & (unlike(OUTLINE[1:3]) <= MISMATCHES)


def _first_common() -> Column:
    """Whether the bucket of this band is the first that two rows share.

    They meet there alone.  As long as they are of two components that bucket stays open, until one of
    them is a hub in it.
    """
    same = F.zip_with(F.slice("bands", F.lit(1), F.col("band")), F.slice("hub_bands", F.lit(1), F.col("band")), lambda x, y: x == y)
    return ~F.exists(same, lambda x: x)


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``(node, label)`` of the linked rows, the smallest row of each component, after further ``(a, b)`` links.

    Links are first taken to the components they connect, so that however many rows of two groups are
    linked, one edge is left of them.
    """
    if labels is None:
        return components(links)
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("label_a")), "a", "left")
    ends = ends.join(labels.select(F.col("node").alias("b"), F.col("label").alias("label_b")), "b", "left")
    edges = ends.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    merged = components(edges)
    moved = labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("now")), "label", "left")
    return stage(moved.select("node", F.coalesce("now", "label").alias("label")).union(merged.select("node", "label")).distinct(), "labels")


def _first_pairs(buckets: DataFrame) -> DataFrame:
    """``(a, b)``, ``b`` the smaller: each row with the most central row that it shares a bucket with.

    Central is who has most company over all buckets.  The text that copies were made from is closer to
    all of them than they are to each other, so a group of copies is linked here, by a pair for each.
    """
    company = buckets.groupBy("row").agg(F.sum("n").alias("company"))
    ranked = buckets.join(company, "row").withColumn("rank", F.struct("company", -F.col("row")))
    centres = ranked.groupBy("bucket").agg(F.max("rank").alias("centre"))
    met = buckets.select("bucket", "row").join(centres, "bucket").withColumn("centre_row", -F.col("centre.col2")).filter("row <> centre_row")
    best = met.groupBy("row").agg((-F.max("centre")["col2"]).alias("centre"))
    return best.select(F.greatest("row", "centre").alias("a"), F.least("row", "centre").alias("b")).distinct()


def near_classes(docs: DataFrame, row: str, text: str = "text", least: float = 0.8) -> DataFrame:
    """``(row, class_id)`` for the distinct values of the bigint ``row``: rows of one class are linked, directly
    or through others, by similarities of at least ``least``; the class id is the smallest row.

    Rows of a null ``row`` have no class.  An id of unlike texts has a row for each of their classes.  If the smallest member of a class is such a
    text, but not the one of the smallest hash, a hash of id and text is the class id.
    """
    texts = _identified(docs, row, text)
    repeated = _repeated_ids(texts)
    if repeated is None:
        return _classes(texts, least)
    return _unit_classes(texts, repeated, least).select("row", F.col("own.unit").alias("class_id")).distinct()


def _identified(docs: DataFrame, row: str, text: str) -> DataFrame:
    """The texts with an id; rows without one belong to no class."""
    return docs.select(F.col(row).alias("row"), F.col(text).cast("string").alias("text")).filter("row is not null")


def _repeated_ids(texts: DataFrame) -> DataFrame | None:
    """``(id, first_mark)`` of the ids of unlike texts, told apart by their hash; None without such ids."""
    marks = texts.groupBy(F.col("row").alias("id")).agg(F.min(F.xxhash64("text")).alias("first_mark"), F.max(F.xxhash64("text")).alias("last_mark"))
    repeated = stage(marks.filter("first_mark <> last_mark").select("id", "first_mark"), "repeated-ids")
    return None if repeated.isEmpty() else repeated


def _unit_classes(texts: DataFrame, repeated: DataFrame, least: float) -> DataFrame:
    """``(row, mark, own)`` for each text of each id: ``own`` is the ``(row, mark, unit)`` of the smallest of its class."""
    marked = texts.withColumn("mark", F.xxhash64("text")).join(bounded(repeated), F.col("row") == F.col("id"), "left")
    number = F.when(F.col("first_mark").isNull() | (F.col("mark") == F.col("first_mark")), F.col("row")).otherwise(F.xxhash64("row", "mark", F.lit(5)))
    units = stage(marked.select("row", "mark", number.alias("unit"), "text"), "units")
    classes = _classes(units.select(F.col("unit").alias("row"), "text"), least).withColumnRenamed("row", "unit")
    classed = stage(units.select("row", "mark", "unit").distinct().join(classes, "unit"), "unit-classes")
    owners = classed.groupBy("class_id").agg(F.min(F.struct("row", "mark", "unit")).alias("own"))
    return classed.join(owners, "class_id").select("row", "mark", "own")


def _classes(texts: DataFrame, least: float) -> DataFrame:
    """``(row, class_id)`` of texts whose ``row`` identifies them."""
    fields = ", ".join(f"{c} bigint" for c in ("row", "weight", "mark1", "mark2", *OUTLINE[1:]))
    signed = stage(texts.filter("text is not null").mapInArrow(_sign, f"{fields}, bands array<bigint>"), "signatures")
    # texts without words are equal only if they are the same
    bare = texts.filter("text is not null").join(signed.filter("weight = 0").select("row").distinct(), "row", "left_semi")
    bare = bare.select("row", F.md5("text").alias("digest"))
    bare_class = bare.join(bare.groupBy("digest").agg(F.min("row").alias("class")), "digest").select("row", "class")
    worded = signed.filter("weight > 0")
    firsts = worded.groupBy("mark1", "mark2").agg(F.min("row").alias("class"))
    classes = worded.select("row", "mark1", "mark2").join(firsts, ["mark1", "mark2"]).select("row", "class")
    classes = stage(classes.unionByName(bare_class).groupBy("row").agg(F.min("class").alias("class")), "classes")

    # one row of each class: repeated rows have the same bands
    heads = worded.join(classes.filter("row = class").select("row"), "row", "left_semi").dropDuplicates(["row"])
    heads = stage(heads.select("row", "bands", *OUTLINE), "heads")
    members = heads.select("row", F.posexplode("bands").alias("band", "hash")).select("row", "band", F.xxhash64("band", "hash").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stage(members.join(shared, "bucket"), "buckets")
    tried = stage(_first_pairs(buckets), "pairs")
    merged = _joined(None, stage(verify(tried, texts, least).distinct(), "links"))
    open_buckets = buckets.select("bucket", "band", "row")
    hubs = 1
    while True:
        labelled = open_buckets.join(merged, open_buckets.row == merged.node, "left")
        labelled = stage(labelled.select("bucket", "band", "row", F.coalesce("label", "row").alias("label")), "labelled")
        mixed = labelled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("bucket", "n")
        open_rows = stage(labelled.join(mixed, "bucket").join(heads, "row"), "open")
        if open_rows.isEmpty():
            break
        hubs *= GROWTH
        chosen = (F.col("n") <= SMALL_BUCKET) | (F.pmod(F.xxhash64("row", F.lit(hubs)), F.col("n")) < hubs)
        hub_rows = open_rows.filter(chosen).select("bucket", *[F.col(c).alias("hub" if c == "row" else "hub_" + c) for c in ("row", "label", "bands", *OUTLINE)])
        met = open_rows.join(hub_rows, "bucket").filter((F.col("label") != F.col("hub_label")) & _may_be_similar(least) & _first_common())
        fresh = met.select(F.least("row", "hub").alias("b"), F.greatest("row", "hub").alias("a")).distinct()
        fresh = stage(fresh.join(tried, ["a", "b"], "left_anti").select("a", "b"), "pairs")
        links = stage(verify(fresh, texts, least).distinct(), "links")
        if not links.isEmpty():
            merged = _joined(merged, links)
        tried = tried.unionByName(fresh)
        # a hub has met all others of its bucket
        open_buckets = open_rows.filter(~chosen).select("bucket", "band", "row")
    merged = merged.withColumnRenamed("node", "class")
    named = classes.join(merged, "class", "left").select("row", F.coalesce("label", "class").alias("class_id"))
    rest = texts.filter("text is null").select("row").distinct().join(classes.select("row"), "row", "left_anti").select("row", F.col("row").alias("class_id"))
    return named.unionByName(rest)


def keep_one_of_each(docs: DataFrame, row: str, text: str = "text", least: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class, of its smallest id; all columns stay as they are.

    Texts of one id are classed each.  Rows without an id or text belong to no class and stay.
    """
    texts = _identified(docs, row, text)
    repeated = _repeated_ids(texts)
    mark = F.xxhash64(docs[text].cast("string"))
    if repeated is None:
        later = _classes(texts, least).filter("row <> class_id").select(F.col("row").alias("__later"))
        kept = docs.join(later, docs[row] == F.col("__later"), "left_anti")
    else:
        later = _unit_classes(texts, repeated, least).filter("struct(row, mark) <> struct(own.row, own.mark)")
        later = later.select(F.col("row").alias("__later"), F.col("mark").alias("__mark"))
        kept = docs.join(later, (docs[row] == F.col("__later")) & (mark == F.col("__mark")), "left_anti")
    # equal texts of one id: counted apart, as hardly any row is one
    held = texts.filter("text is not null").groupBy(F.col("row").alias("__id"), F.xxhash64("text").alias("__mark"))
    again = stage(held.count().filter("count > 1").select("__id", "__mark"), "repeated-rows")
    if again.isEmpty():
        return kept
    same = (docs[row] == F.col("__id")) & (mark == F.col("__mark"))
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates([row, text]))
