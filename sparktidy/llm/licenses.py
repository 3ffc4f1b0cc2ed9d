"""License scan: MinHash bands over overlapping windows retrieve templates, shingle containment verifies.

Texts and templates are sequences of five-word shingles.  A template of ``q`` shingles belongs to a size
class of block length ``B``; texts are cut into blocks of ``B`` shingles, and every two neighbouring
blocks are a window.  With ``q >= 3 B - 1`` a whole window lies inside the template wherever it begins,
so templates contribute their windows at every offset and the right one is the same set of shingles.
A band is a single min-hash of a window: sets of similarity ``s`` share one of the ``BANDS`` with
probability 1 - (1 - s)^24, that is 1 when nothing in the window was altered and 0.99999 at 0.4.
Templates of fewer than 11 shingles are looked up shingle by shingle, which misses none.

A hit is verified on the whole text: the positions of the template's shingles, cut where more than
``q`` others lie between and where the template starts over, must hold at least ``least`` (0.8) of its
distinct shingles.  It starts over where a shingle comes once more than in the template, at the farthest
step back before it; parts that complete each other and repeat no more than ``1 - least`` of the template
are one passage with a stutter.  A passage inside another one that a template fits better is left out.

Null and empty texts hold nothing.  Texts of fewer than five words hold no license, and templates of
fewer than five words are an error.  Repeated rows are reported each.  ``TEMPLATES_A_PASS`` bounds what
a task holds; more templates take more passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._text import Words, mix, row_slices, shingles

BANDS = 24
BLOCKS = (4, 8, 16)
TEMPLATES_A_PASS = 2_000
_A = mix(np.arange(BANDS), 300) | np.uint64(1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

# Usual wordings of public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-permission": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    ),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def _class_of(q: int) -> int:
    """Largest block length of which every window grid has one inside the template; 0 for short ones."""
    return max((b for b in BLOCKS if q >= 3 * b - 1), default=0)


def block_minima(doc: np.ndarray, value: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(B, doc, first shingle, min-hashes)`` of all windows, for each block length.

    Minima of longer blocks come from those of shorter ones.
    """
    if not len(doc):
        return
    begin = np.searchsorted(doc, doc)  # where the document of each shingle begins
    inner = np.arange(len(doc)) - begin
    starts = np.flatnonzero(inner % BLOCKS[0] == 0)
    with np.errstate(over="ignore"):
        minima = np.stack([np.minimum.reduceat(value * a, starts) for a in _A], axis=1)
    number = inner[starts] // BLOCKS[0]
    for b in BLOCKS:
        if b != BLOCKS[0]:
            heads = np.flatnonzero(number % 2 == 0)
            minima = np.minimum.reduceat(minima, heads, axis=0)
            starts, number = starts[heads], number[heads] // 2
        window = minima.copy()
        follows = np.append(doc[starts][1:] == doc[starts][:-1], False)
        window[follows] = np.minimum(minima[follows], minima[np.flatnonzero(follows) + 1])
        yield b, doc[starts], starts, window


def template_index(templates: Mapping[str, str]) -> dict:
    """Short templates by shingle, longer ones by class and band; and the shingles of each."""
    names = list(templates)
    doc, value = shingles(Words(pa.array([templates[n] for n in names])), 5)
    sets = [np.unique(value[doc == i]) for i in range(len(names))]
    places = []  # of each shingle of a template: where it comes first, and how often
    for i in range(len(names)):
        _, at, times = np.unique(value[doc == i], return_index=True, return_counts=True)
        places.append((at, times))
    if any(len(Words(pa.array([templates[n]])).hash) < 5 for n in names):
        raise ValueError("a template needs five words")
    entries: dict[int, list[tuple[int, int]]] = {0: []}
    for i in range(len(names)):
        own = value[doc == i]
        b = _class_of(len(own))
        if not b:
            entries[0] += [(int(v), i) for v in sets[i]]
            continue
        with np.errstate(over="ignore"):
            for s in range(len(own) - 2 * b + 1):
                for band, a in enumerate(_A):
                    entries.setdefault(b * 100 + band, []).append((int((own[s : s + 2 * b] * a).min()), i))
    tables = {}
    for key, rows in entries.items():
        rows = sorted(set(rows))
        tables[key] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64))
    return {"names": names, "sets": sets, "places": places, "tables": tables}


def _lookup(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(index in wanted, template)`` of all equal hashes."""
    keys, template = table
    low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
    hit = np.flatnonzero(high > low)
    times = high[hit] - low[hit]
    at = np.repeat(low[hit] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
    return np.repeat(hit, times), template[at]


def occurrences(found: np.ndarray, at: np.ndarray, times: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
    """``(begin, end)`` of the occurrences of one template among its ``found`` shingles, given by number."""
    if (np.bincount(found, minlength=len(at)) <= times).all():
        yield 0, len(found)
        return
    step = np.diff(at[found], prepend=at[found[0]])
    parts, begin, where = [], 0, [[] for _ in at]
    for t, x in enumerate(found.tolist()):
        where[x].append(t)
        inside = [p for p in where[x][-int(times[x]) - 1 :] if p >= begin]
        if len(inside) > times[x]:
            near = step[inside[-2] + 1 : t + 1]
            start = t - int(np.argmin(near[::-1]))
            parts.append((begin, start))
            begin = start
    parts.append((begin, len(found)))
    kinds = [set(found[a:b].tolist()) for a, b in parts]
    whole = [len(x) / len(at) >= least for x in kinds]
    slack = (1 - least) * len(at) + 1e-9
    k = 0
    while k < len(parts):
        best, seen, repeated = k, set(kinds[k]), 0
        most, later, rest = len(seen), 0, set()
        for j in range(k + 1, len(parts)):
            repeated += len(seen & kinds[j])
            if repeated > slack or whole[j] and any(whole[k:j]):
                break
            seen |= kinds[j]
            rest |= kinds[j]
            if len(seen) > most:
                best, most, later = j, len(seen), len(rest)
        if whole[k] or most / len(at) >= least and most > later:
            yield parts[k][0], parts[best][1]
            k = best + 1
        else:
            k += 1


def scan_batch(texts: pa.Array, index: dict, least: float) -> Iterator[tuple[int, str, int, int, float]]:
    """``(doc, license, first word, words, containment)`` of all passages."""
    doc, value = shingles(words := Words(texts), 5)
    long_enough = np.diff(words.per_doc()) >= 5
    keep = long_enough[doc] if len(doc) else np.zeros(0, bool)
    doc, value = doc[keep], value[keep]
    found: set[tuple[int, int]] = set()
    hit, template = _lookup(index["tables"][0], value)
    found.update(zip(doc[hit].tolist(), template.tolist()))
    for b, owner, _, window in block_minima(doc, value):
        for band in range(BANDS):
            if (table := index["tables"].get(b * 100 + band)) is not None:
                hit, template = _lookup(table, window[:, band])
                found.update(zip(owner[hit].tolist(), template.tolist()))
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    passages: list[tuple[int, str, int, int, float]] = []
    for d, i in sorted(found):
        own, wanted = value[first[d] : first[d + 1]], index["sets"][i]
        at = np.flatnonzero(np.isin(own, wanted))
        for cluster in np.split(at, np.flatnonzero(np.diff(at) > len(wanted)) + 1):
            if len(cluster) / len(wanted) < least:
                continue
            for begin, end in occurrences(np.searchsorted(wanted, own[cluster]), *index["places"][i], least):
                part = cluster[begin:end]
                share = len(np.unique(own[part])) / len(wanted)
                if share >= least:
                    passages.append((d, index["names"][i], int(part[0]), int(part[-1] - part[0] + 5), share))
    by_doc: dict[int, list[tuple[int, str, int, int, float]]] = {}
    for x in passages:
        by_doc.setdefault(x[0], []).append(x)
    for x in passages:
        if not any(y[4] > x[4] and y[2] <= x[2] and x[2] + x[3] <= y[2] + y[3] for y in by_doc[x[0]]):
            yield x


def _scan(shared, least: float, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "__text"):
                rows = list(scan_batch(part.column("__text"), shared.value, least))
                take = pa.array([r[0] for r in rows], pa.int64())
                columns = [part.column(c).take(take) for c in keep]
                found = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.string()), (2, pa.int32()), (3, pa.int32()), (4, pa.float64()))]
                yield pa.RecordBatch.from_arrays([*columns, *found], names=[*keep, "license", "first_word", "n_words", "containment"])

    return run


def scan_licenses(df: DataFrame, text: str = "text", keep: list[str] | None = None, templates: Mapping[str, str] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """``keep`` with ``license``, ``first_word``, ``n_words`` and ``containment``: one row per licensed passage.

    Null and empty texts have none; repeated rows come out each; columns named like the results, in any
    case, are replaced.
    """
    added = ("license", "first_word", "n_words", "containment")
    keep = [c for c in (keep if keep is not None else df.columns) if c.lower() not in added]
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    fields += ", license string, first_word int, n_words int, containment double"
    source = df.select(*keep, F.col(text).cast("string").alias("__text"))
    items = sorted(templates.items())
    passes = []
    for k in range(0, len(items), TEMPLATES_A_PASS):
        shared = df.sparkSession.sparkContext.broadcast(template_index(dict(items[k : k + TEMPLATES_A_PASS])))
        passes.append(source.mapInArrow(_scan(shared, least, keep), fields))
    return reduce(DataFrame.unionAll, passes)
