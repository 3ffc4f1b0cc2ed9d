"""Quality by Bradley-Terry pairwise ranking.

A text is described by shape statistics (words, lines, characters, repetition), each cut into ten
quantile steps.  Training rows of unlike label form preference pairs, every row of the larger class
with ``partners`` rows of the other one, and a logistic loss on the differences of their features
gives the document score.  The threshold is the score quantile that leaves the training share of low
quality below it; a score is the Bradley-Terry probability of beating a document at the threshold.

All labelled training rows train the model: quantiles, pairs and the threshold are taken over all of them, in tasks.
Null, empty and
wordless texts get the score of their all-zero statistics; without both labels every score is 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._frames import bounded
from sparktidy.llm._text import Words, row_slices, shingles, utf8
from sparktidy.operators.numbering import number_rows
from sparktidy.workspace import stage

NAMES = (
    "log_words", "word_length", "word_spread", "long_words", "short_words", "distinct_words", "top_word", "repeated_next",
    "distinct_pairs", "distinct_fives", "punctuation", "symbols", "exclamations", "digits", "capitals", "bars", "log_lines",
    "line_words", "distinct_lines", "sentence_words", "non_ascii", "spaces",
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+<=>@[]^_`{|}~\\/"]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in ".,;:!?'\"()-"]] = True


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(mask, dtype=np.int64))
    return np.diff(total[offsets]).astype(float)


def _distinct(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the number of distinct values and the largest count of one."""
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    fresh = np.ones(len(d), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, len(d)))
    most = np.zeros(n)
    np.maximum.at(most, d[at], runs)
    return np.bincount(d[at], minlength=n).astype(float), most


def text_statistics(texts: pa.Array) -> np.ndarray:
    """One row of :data:`NAMES` per text."""
    n = len(texts)
    raw, offsets = utf8(texts)
    words = Words(texts)
    count = np.diff(words.per_doc()).astype(float)
    some = np.maximum(count, 1)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    length = (words.end - words.start).astype(float)
    per_word = lambda x: np.bincount(words.doc, weights=x, minlength=n) / some
    mean = per_word(length)
    spread = np.sqrt(np.maximum(per_word(length**2) - mean**2, 0))
    kinds, most = _distinct(words.doc, words.hash, n)
    again = np.zeros(len(words.hash))
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    grams = []
    for k in (2, 5):
        doc, value = shingles(words, k)
        grams.append(_distinct(doc, value, n)[0] / np.maximum(np.bincount(doc, minlength=n), 1))
    breaks = raw == 10
    lines = _sums(breaks, offsets) + (np.diff(offsets) > 0)
    held = [len(set(t.split("\n"))) if t else 0 for t in texts.to_pylist()]
    stops = _sums((raw == 46) | (raw == 33) | (raw == 63), offsets)
    columns = [
        np.log1p(count), mean, spread, per_word(length > 8), per_word(length <= 3), kinds / some, most / some, per_word(again),
        grams[0], grams[1], _sums(_PUNCTUATION[raw], offsets) / size, _sums(_SYMBOL[raw], offsets) / size,
        _sums(raw == 33, offsets) / size, _sums((raw >= 48) & (raw <= 57), offsets) / size,
        _sums((raw >= 65) & (raw <= 90), offsets) / size, _sums(raw == 124, offsets) / size, np.log1p(lines),
        count / np.maximum(lines, 1), np.array(held, float) / np.maximum(lines, 1), count / (stops + 1),
        _sums(raw >= 128, offsets) / size, _sums(raw == 32, offsets) / size,
    ]
    return np.stack(columns, axis=1)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in row_slices(batch, "__text"):
            features = text_statistics(part.column("__text"))
            flat = pa.ListArray.from_arrays(np.arange(0, features.size + 1, features.shape[1], dtype=np.int32), pa.array(features.ravel()))
            at = part.schema.names.index("__text")
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(part.columns) if i != at), flat], names=[*(x for i, x in enumerate(part.schema.names) if i != at), "__features"])


def describe(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the array ``__features``."""
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return df.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(_describe, f"{fields}, __features array<double>")


@dataclass
class RankModel:
    cuts: np.ndarray  # features x steps
    weights: np.ndarray  # features x (steps + 1)
    threshold: float

    def rank(self, features: np.ndarray) -> np.ndarray:
        total = np.zeros(len(features))
        for j, cuts in enumerate(self.cuts):
            total += self.weights[j][np.searchsorted(cuts, features[:, j], side="right")]
        return total

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.rank(features) - self.threshold, -30, 30)))


def fit(features: np.ndarray, good: np.ndarray, steps: int = 10, partners: int = 2, ridge: float = 1.0, rounds: int = 12, seed: int = 11) -> RankModel:
    """Newton steps on the logistic loss of feature differences."""
    cuts = np.stack([np.quantile(x, np.linspace(0, 1, steps + 1)[1:-1]) for x in features.T])
    width = steps
    hot = np.zeros((len(features), features.shape[1] * width), np.float32)
    for j, c in enumerate(cuts):
        hot[np.arange(len(features)), j * width + np.searchsorted(c, features[:, j], side="right")] = 1
    better, worse = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    pairs = max(len(better), len(worse)) * partners
    rng = np.random.default_rng(seed)
    fill = lambda rows: np.concatenate([rng.permutation(rows) for _ in range(-(-pairs // len(rows)))])[:pairs]
    difference = hot[fill(better)] - hot[fill(worse)]
    w = np.zeros(hot.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(difference @ w, -30, 30)))
        gradient = difference.T @ (p - 1) + ridge * w
        hessian = (difference * (p * (1 - p))[:, None].astype(np.float32)).T @ difference + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    model = RankModel(cuts, w.reshape(-1, width), 0.0)
    ranks = model.rank(features)
    model.threshold = float(np.quantile(ranks, (good == 0).mean()))
    return model


def _cells(features: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Per row the position of its step of each feature."""
    return np.stack([j * (len(c) + 1) + np.searchsorted(c, features[:, j], side="right") for j, c in enumerate(cuts)], 1)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _stepped(cuts: np.ndarray, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = pa.array(list(_cells(_matrix(batch.column("__features"), len(batch)), cuts).astype(np.int16)), pa.list_(pa.int16()))
                yield pa.RecordBatch.from_arrays([*map(batch.column, others), cells], names=[*others, "cells"])

    return run


def _sums_of_pairs(w: np.ndarray):
    """Per task the Hessian of the loss over its pairs, with the gradient as the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(w), len(w) + 1))
        for batch in batches:
            better, worse = (_matrix(batch.column(c), len(batch)) for c in ("better", "worse"))
            for at in range(0, len(batch), 4096):
                up, down = better[at : at + 4096], worse[at : at + 4096]
                difference, rows = np.zeros((len(up), len(w)), np.float32), np.arange(len(up))[:, None]
                difference[rows, up] += 1
                difference[rows, down] -= 1
                p = 1 / (1 + np.exp(-np.clip(w[up].sum(1) - w[down].sum(1), -30, 30)))
                total[:, :-1] += (difference * (p * (1 - p))[:, None].astype(np.float32)).T @ difference
                total[:, -1] += difference.T @ (p - 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(w)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    return run


def _ranks(w: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(w[_matrix(batch.column("cells"), len(batch))].sum(1))], names=["rank"])

    return run


def train(described: DataFrame, label: str, steps: int = 10, partners: int = 2, ridge: float = 1.0, rounds: int = 12) -> RankModel | None:
    """From all rows of ``(id, __features, label)``: :func:`fit` over tasks, which send the sums of their pairs."""
    rows = stage(described.select("id", "__features", label), "quality-training")
    counts = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count(F.lit(1))).collect()}
    if len(counts) < 2:
        return None
    shares = np.linspace(0, 1, steps + 1)[1:-1].tolist()
    cuts = np.array(rows.agg(*[F.percentile_approx(F.col("__features")[j], shares, 10_000).alias(f"q{j}") for j in range(len(NAMES))]).first())
    id_type = rows.schema["id"].dataType.simpleString()
    cells = stage(rows.mapInArrow(_stepped(cuts, ["id", label]), f"id {id_type}, {label} int, cells array<smallint>"), "quality-cells")

    # every row of the larger class meets ``partners`` rows of the other one, which take turns
    large = max(counts, key=lambda k: (counts[k], k))
    many = number_rows(cells.filter(F.col(label) == large).select("id", "cells"), [F.xxhash64("id", F.lit(11)), F.col("id")], "place", 0)
    few = number_rows(cells.filter(F.col(label) != large).select("id", "cells"), [F.xxhash64("id", F.lit(13)), F.col("id")], "place", 0)
    turn = F.explode(F.transform(F.sequence(F.lit(0), F.lit(partners - 1)), lambda k: F.pmod(F.col("place") * partners + k, F.lit(counts[1 - large]))))
    mine, other = ("better", "worse") if large == 1 else ("worse", "better")
    pairs = many.select(F.col("cells").alias(mine), turn.alias("place")).join(bounded(few.select("place", F.col("cells").alias(other))), "place")
    pairs = stage(pairs.select("better", "worse"), "quality-pairs")
    w = np.zeros(len(NAMES) * steps)
    for _ in range(rounds):
        sums = pairs.mapInArrow(_sums_of_pairs(w), "i int, sums array<double>").select("i", F.posexplode("sums").alias("j", "x"))
        total = np.zeros((len(w), len(w) + 1))
        for i, xs in sums.groupBy("i", "j").agg(F.sum("x").alias("x")).groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "x")))["x"]).collect():
            total[i] = xs
        step = np.linalg.solve(total[:, :-1] + ridge * np.eye(len(w)), total[:, -1] + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    low = counts.get(0, 0) / sum(counts.values())
    threshold = cells.select("cells").mapInArrow(_ranks(w), "rank double").agg(F.percentile_approx("rank", F.lit(low), F.lit(100_000))).first()[0]
    return RankModel(cuts, w.reshape(-1, steps), float(threshold))


def _rate(shared, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = RankModel(*shared.value)
        for batch in batches:
            features = batch.column("__features").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            yield pa.RecordBatch.from_arrays([*map(batch.column, others), pa.array(model.score(features))], names=[*others, "score"])

    return run


def score_quality(described: DataFrame, model: RankModel | None) -> DataFrame:
    """The described rows with ``score`` in place of the features; a column of that name, in any case, is replaced.

    Repeated rows and rows of a null id are scored each.
    """
    others = [c for c in described.columns if c.lower() not in ("__features", "score")]
    if model is None:
        return described.select(*others, F.lit(1.0).alias("score"))
    shared = described.sparkSession.sparkContext.broadcast((model.cuts, model.weights, model.threshold))
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in described.select(*others).schema)
    return described.mapInArrow(_rate(shared, others), f"{fields}, score double")


def training_features(described: DataFrame, labels: DataFrame, label: str, training: Column, doc_id: str = "doc_id") -> DataFrame:
    """``(id, __features, label)`` of the labelled rows whose id fulfils ``training``."""
    known = labels.filter(training).filter(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias(label))
    return described.filter(training).select(F.col(doc_id).alias("id"), "__features").join(bounded(known), "id")
