"""Toxic passages: all maximal scoring segments over word log-odds, calibrated by extreme values.

Words and their prefixes (word families in inflected languages) are counted by exact 64-bit hash in a
grouped table over every labelled training row.  Each scores the lower confidence bound of its log-odds
under an informative Dirichlet prior (the corpus frequencies), less a constant; the lexicon holds those
with evidence for toxicity, ``lexicon`` at most, by strength.  A word scores the best of itself and its
prefixes, any other word a negative constant, so that ordinary text drifts down.  A linear scan (Ruzzo and Tompa) finds every
maximal segment of a text.  Karlin and Altschul's theory gives a segment of score ``S`` in a text of
``m`` words the expected count ``K m exp(-lambda S)``; ``lambda`` solves its equation on the words of
clean training rows and ``K`` is fitted to their maxima.  A text sums what its segments with a count
below one gain, and a logistic curve over about ``calibration`` training rows makes that a probability.

Null, empty and wordless texts have no segment and get the score of a text without any.  Repeated rows
are scored each.  Without both kinds of training label every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._frames import bounded, sample_by_hash
from sparktidy.llm._text import Words, row_slices
from sparktidy.workspace import stage

EULER = 0.5772156649015329
LEXICON = 1_000_000  # entries of a model at most, those of the strongest evidence
PENDING = 500_000  # distinct hashes that a counting task holds
SIEVE = 20  # bits
PREFIXES = (4, 5, 6, 7, 8)  # bytes


@dataclass
class ToxicModel:
    hashes: np.ndarray  # of words and prefixes that speak for toxicity, in order
    scores: np.ndarray  # of each of them
    other: float  # of any other word
    rate: float  # lambda
    log_k: float
    slope: float
    offset: float

    def gain(self, score: float, words: int) -> float:
        """Minus the logarithm of a segment's expected count."""
        return self.rate * score - self.log_k - np.log(max(words, 1))

    def probability(self, gain: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * gain + self.offset, -30, 30)))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, end, score)``, in one pass (Ruzzo and Tompa, 1999)."""
    found: list[list[float]] = []  # first, end, sum before, sum after
    total, before = np.cumsum(scores), 0.0
    for i in np.flatnonzero(scores > 0):
        before = total[i] - scores[i]
        item = [i, i + 1, before, total[i]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= item[2]:
                j -= 1
            if j < 0 or found[j][3] >= item[3]:
                found.append(item)
                break
            item = [found[j][0], item[1], found[j][2], item[3]]
            del found[j:]
    return [(int(a), int(b), float(s - r)) for a, b, r, s in found]


def _hashes(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(words, hash)`` of the words themselves and of each length of prefix shorter than the word."""
    return [(np.arange(len(words.hash)), words.hash), *words.prefixes(PREFIXES)]


class Lexicon:
    """Scores by exact 64-bit hash; a sieve of their first bits spares most searches."""

    def __init__(self, hashes: np.ndarray, scores: np.ndarray, other: float):
        self.hashes, self.scores, self.other = hashes, scores, other
        self.sieve = np.zeros(1 << SIEVE, bool)
        self.sieve[self._first(hashes)] = True

    @staticmethod
    def _first(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - SIEVE)).astype(np.int64)

    def of_words(self, words: Words) -> np.ndarray:
        """The best score of each word and its prefixes."""
        best = np.full(len(words.hash), self.other)
        if not len(self.hashes):
            return best
        for at, h in _hashes(words):
            near = np.flatnonzero(self.sieve[self._first(h)])
            place = np.minimum(np.searchsorted(self.hashes, h[near]), len(self.hashes) - 1)
            held = self.hashes[place] == h[near]
            np.maximum.at(best, at[near[held]], self.scores[place[held]])
        return best


_COUNTED = pa.schema([("hash", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of every word and prefix in toxic and in other texts."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def combined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        value, toxic, n = (np.concatenate(x) for x in zip(*held))
        value, back = np.unique(value, return_inverse=True)
        return value, np.bincount(back, toxic, len(value)).astype(np.int64), np.bincount(back, n, len(value)).astype(np.int64)

    def rows() -> pa.RecordBatch:
        value, toxic, n = combined()
        held.clear()
        return pa.record_batch([pa.array(value.view(np.int64)), pa.array(toxic), pa.array(n - toxic)], schema=_COUNTED)

    for batch in batches:
        for part in row_slices(batch, "text"):
            words = Words(part.column("text"))
            label = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            found = _hashes(words)
            value, kind = np.concatenate([h for _, h in found]), label[words.doc[np.concatenate([at for at, _ in found])]]
            held.append((value, kind, np.ones(len(value), np.int64)))
            held[:] = [combined()]
            if len(held[0][0]) > PENDING:
                yield rows()
    if held:
        yield rows()


def lexicon_table(counts: DataFrame, toxic: int, clean: int, sigmas: float, drift: float) -> DataFrame:
    """``(hash, score, toxic, clean)``: lower confidence bound of the log-odds, less the drift, where it is positive.

    The Dirichlet prior has as many pseudo-counts of a word as the toxic class has words, by its share.
    """
    prior = (F.col("toxic") + F.col("clean")) * F.lit(toxic / (toxic + clean))
    a, b = F.col("toxic") + prior, F.col("clean") + prior
    delta = F.log(a / (2 * toxic - a + 1e-9)) - F.log(b / (clean + toxic - b + 1e-9))
    bound = delta - sigmas * F.sqrt(1 / a + 1 / b)
    return counts.filter("toxic > 0").withColumn("bound", bound).filter("bound > 0").select("hash", (F.col("bound") - drift).alias("score"), "toxic", "clean")


def karlin_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive solution of sum(p exp(lambda s)) = 1."""
    p = weights / weights.sum()
    if not (scores[weights > 0] > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    value = lambda x: float((p * np.exp(np.minimum(x * scores, 500))).sum())
    while value(high) < 1 and high < 1e3:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 1 else (low, middle)
    return high


def _segments(texts: pa.Array, lexicon: Lexicon) -> Iterator[tuple[Words, int, list[tuple[int, int, float]], int, int]]:
    words = Words(texts)
    value, at = lexicon.of_words(words), words.per_doc()
    positive = np.zeros(len(at) - 1, bool)
    positive[words.doc[value > 0]] = True
    for d in range(len(at) - 1):
        first, end = int(at[d]), int(at[d + 1])
        yield words, d, maximal_segments(value[first:end]) if positive[d] else [], first, end - first


def _maxima(shared):
    schema = pa.schema([("toxic", pa.int32()), ("words", pa.int64()), ("segments", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(*shared.value)
        for batch in batches:
            for part in row_slices(batch, "text"):
                rows = [(n, [s for *_, s in found]) for _, _, found, _, n in _segments(part.column("text"), lexicon)]
                yield pa.record_batch([part.column("toxic").cast(pa.int32()), pa.array([n for n, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.list_(pa.float64()))], schema=schema)

    return run


def logistic_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope (not negative) and offset of a one-dimensional logistic regression, by Newton steps."""
    w = np.zeros(2)
    design = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + ridge * w
        hessian = design.T @ (design * (p * (1 - p) + 1e-6)[:, None]) + ridge * np.eye(2)
        w = w - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return max(float(w[0]), 0.0), float(w[1])


def train(labelled: DataFrame, calibration: int = 20_000, lexicon: int = LEXICON, sigmas: float = 3.0, drift: float = 0.5, other: float = -2.5) -> ToxicModel | None:
    """From ``(id, text, toxic 0/1)``: counts over all rows, calibration on a bounded sample.

    Words and prefixes are counted by exact hash in a grouped table.  Only those with evidence for
    toxicity come to the driver, at most ``lexicon``; every other word scores ``other``.
    """
    spark = labelled.sparkSession
    counts = labelled.mapInArrow(_count, "hash bigint, toxic bigint, clean bigint").groupBy("hash").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = stage(counts, "word-counts")
    totals = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not (totals[0] and totals[1]):
        return None
    found = lexicon_table(counts, *totals, sigmas, drift).orderBy(F.desc("score"), "hash").limit(lexicon).toArrow()
    hashes = found["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, scores, clean = hashes[order], found["score"].to_numpy()[order], found["clean"].to_numpy()[order].astype(float)
    rate = karlin_rate(np.append(scores, other), np.append(clean, totals[1] - clean.sum()))
    shared = spark.sparkContext.broadcast((hashes, scores, other))
    seen = sample_by_hash(labelled, "id", calibration).mapInArrow(_maxima(shared), "toxic int, words bigint, segments array<double>").limit(2 * calibration).collect()
    top = np.array([rate * max(r.segments) - np.log(r.words) for r in seen if not r.toxic and r.segments])
    model = ToxicModel(hashes, scores, other, rate, float(top.mean() - EULER) if len(top) else 0.0, 1.0, 0.0)
    gains = np.array([total_gain(model, r.segments, r.words) for r in seen])
    model.slope, model.offset = logistic_curve(gains, np.array([float(r.toxic) for r in seen]))
    shared.unpersist()
    return model


def total_gain(model: ToxicModel, segments: list[float], words: int) -> float:
    gains = [model.gain(s, words) for s in segments]
    return float(sum(g for g in gains if g > 0))


def _score(shared, keep: list[str]):
    out = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("gain", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicModel(*shared.value)
        lexicon = Lexicon(model.hashes, model.scores, model.other)
        for batch in batches:
            for part in row_slices(batch, "__text"):
                gains, passages = [], []
                for words, _, found, first, n in _segments(part.column("__text"), lexicon):
                    significant = [(a, b, g) for a, b, s in found if (g := model.gain(s, n)) > 0]
                    gains.append(sum(g for *_, g in significant))
                    passages.append([{"begin": a, "end": b, "gain": g} for a, b, g in significant])
                p = model.probability(np.array(gains, float))
                yield pa.RecordBatch.from_arrays([*map(part.column, keep), pa.array(p), pa.array(passages, out)], names=[*keep, "score", "passages"])

    return run


def score_toxicity(df: DataFrame, model: ToxicModel | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) with ``score``, the probability that a text is toxic, and ``passages``, its
    significant passages as word positions.  Columns of these names, in any case, are replaced."""
    keep = [c for c in (keep if keep is not None else df.columns) if c.lower() not in ("score", "passages")]
    kind = "array<struct<begin:int,end:int,gain:double>>"
    if model is None:
        return df.select(*keep, F.lit(0.0).alias("score"), F.array().cast(kind).alias("passages"))
    shared = df.sparkSession.sparkContext.broadcast((model.hashes, model.scores, model.other, model.rate, model.log_k, model.slope, model.offset))
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return df.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(_score(shared, keep), f"{fields}, score double, passages {kind}")


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, text, <label>)`` of the labelled documents whose id fulfils ``training``."""
    known = labels.filter(training).filter(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias(label))
    texts = docs.filter(training).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return texts.join(bounded(known), "id")
