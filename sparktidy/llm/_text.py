"""Vectorised words, shingles and hashes over Arrow batches.

A *word* is a maximal run of ASCII letters, digits and non-ASCII characters of the lower-cased text.
Hashes are 64-bit polynomials over random byte values, mixed to full avalanche.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_GOLDEN = 0x9E3779B97F4A7C15
_ODD = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Avalanche of 64-bit values; each seed gives an independent function."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed + 1) * _GOLDEN & _MASK)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def byte_values(seed: int = 0) -> np.ndarray:
    """A random odd 64-bit value for each byte."""
    return mix(np.arange(256), 1000 + seed) | np.uint64(1)


_VALUES = byte_values()


class _Powers:
    """Powers of an odd base modulo 2^64, as many as asked for."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            size = max(n, 2 * len(self.table))
            factors = np.full(size, self.base, np.uint64)
            factors[0] = 1
            self.table = np.multiply.accumulate(factors)
        return self.table[:n]


powers = _Powers(_ODD)
inverse_powers = _Powers(pow(_ODD, -1, 1 << 64))


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, beside those of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def row_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most ``limit`` bytes of text; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += int(n)
    if len(sizes) > first:
        yield batch.slice(first)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each begins (one more entry than texts); null is empty."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


class Words:
    """The words of a batch of texts: ``doc`` (row), ``hash``, ``start`` and ``end`` byte in ``data``."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        self.data, self.offsets = utf8(pc.utf8_lower(texts) if lower else texts)
        inside = _WORD[self.data]
        fresh = np.ones(len(inside) + 1, bool)
        fresh[1:-1] = ~inside[:-1]
        fresh[self.offsets] = True
        last = np.append(~inside[1:], True)[: len(inside)]
        last[self.offsets[1:][self.offsets[1:] > 0] - 1] = True
        self.start = np.flatnonzero(inside & fresh[:-1])
        self.end = np.flatnonzero(inside & last) + 1
        self.doc = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.hash = span_hashes(self.data, self.start, self.end)

    def prefixes(self, lengths: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length ``(words, hash)``: the longer words and the hash of their first bytes."""
        at, acc, out = np.arange(len(self.start)), np.zeros(len(self.start), np.uint64), []
        for k in range(max(lengths)):
            keep = self.end[at] - self.start[at] > k + 1
            at, acc = at[keep], acc[keep]
            with np.errstate(over="ignore"):
                acc = acc * np.uint64(_ODD) + _VALUES[self.data[self.start[at] + k]]
            if k + 1 in lengths:
                out.append((at, mix(acc, 50 + k)))
        return out

    def per_doc(self) -> np.ndarray:
        """Where the words of each text begin (one more entry than texts)."""
        return np.searchsorted(self.doc, np.arange(len(self.offsets)))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each non-empty span of bytes; spans are ascending and do not overlap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    first = np.cumsum(size) - size
    inner = np.arange(int(size.sum())) - np.repeat(first, size)
    with np.errstate(over="ignore"):
        value = _VALUES[data[inner + np.repeat(start, size)]] * powers(int(size.max()))[inner]
        return mix(np.add.reduceat(value, first) + size.astype(np.uint64))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(doc, hash)`` of every ``n`` consecutive words; a shorter text has one shingle of all its words."""
    at, h = words.per_doc(), words.hash
    docs, out = [], []
    with np.errstate(over="ignore"):
        if len(h) >= n:
            whole = np.flatnonzero(words.doc[: len(h) - n + 1] == words.doc[n - 1 :])
            combined = np.zeros(len(whole), np.uint64)
            for k in range(n):
                combined = combined * np.uint64(_ODD) + h[whole + k]
            docs.append(words.doc[whole])
            out.append(mix(combined, 1))
        count = np.diff(at)
        for d in np.flatnonzero((count > 0) & (count < n)):
            combined = np.zeros(1, np.uint64)
            for k in range(at[d], at[d + 1]):
                combined = combined * np.uint64(_ODD) + h[k]
            docs.append(np.array([d]))
            out.append(mix(combined, 2 + int(count[d])))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, value = np.concatenate(docs), np.concatenate(out)
    order = np.argsort(doc, kind="stable")
    return doc[order], value[order]
