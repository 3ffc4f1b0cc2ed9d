"""Line dedup by pairwise alignment: shared rare lines pair documents, patience diff aligns them.

A line of few words is common by chance, a long one is not, however many documents repeat it.  So the
key of a line is the hash of as many lines, from it on, as it takes to reach ``KEY_WORDS`` words.  Every
document is paired with the first holder (smallest id) of each of its keys: at most one pair per line,
whatever the number of holders, and no frequent line is left out.

Each pair is aligned by patience diff: equal lines at both ends, then lines that are unique on either
side in their longest common order, then the gaps between them likewise.  What stays unaligned is
aligned anew, for blocks that changed their order.  Blocks of at least ``KEY_WORDS`` words count; those
that patience diff leaves out, as their lines are not unique or cross a longer chain, are matched by
their windows of so many words, so no block that both documents hold stays unaligned.  A
document loses the runs of lines that are aligned with earlier documents, if a run has at least
``min_words`` words; the first holder keeps them.

Lines end at ``\\n``.  Ids order the documents; rows of one id with unlike texts are told apart by the
hash of the text, and equal rows are one document.  Null texts and null ids take no part.  A text
whose lines all go becomes empty.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._frames import bounded
from sparktidy.llm._text import row_slices
from sparktidy.workspace import stage

KEY_WORDS = 8
_SIGNED = 1 << 63
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)


def _hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - _SIGNED


def line_keys(lines: Sequence[int], words: Sequence[int]) -> list[int]:
    """Key of each line that, with the lines after it, reaches KEY_WORDS words."""
    out, end, total = [], 0, 0
    for i, n in enumerate(words):
        while end < len(words) and total < KEY_WORDS:
            total += words[end]
            end += 1
        if total < KEY_WORDS:
            break
        if n:
            out.append(lines[i] if end == i + 1 else xxhash.xxh3_64_intdigest(repr(lines[i:end]).encode()) - _SIGNED)
        total -= n
    return out


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.int64())
    for batch in batches:
        for part in row_slices(batch, "text"):
            columns = ([], [], [])
            for text in part.column("text").to_pylist():
                rows = text.split("\n")
                lines, words = [_hash(x) for x in rows], [len(x.split()) for x in rows]
                for column, value in zip(columns, (lines, words, line_keys(lines, words))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("mark"), *(pa.array(c, kind) for c in columns)], names=["row", "mark", "lines", "words", "keys"]
            )


def _in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence in which the second numbers rise; the first ones do already."""
    tails: list[int] = []
    heads: list[int] = []  # index of the pair that ends each length
    before: list[int] = []
    for k, (_, y) in enumerate(pairs):
        n = bisect_left(tails, y)
        before.append(heads[n - 1] if n else -1)
        if n == len(tails):
            tails.append(y)
            heads.append(k)
        else:
            tails[n], heads[n] = y, k
    out, k = [], heads[-1] if heads else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(a: Sequence[int], b: Sequence[int], first: int = 0, end: int | None = None) -> list[tuple[int, int]]:
    """Aligned ``(position in a, position in b)``, for the part of ``b`` from ``first`` to ``end``."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), first, len(b) if end is None else end)]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1}
        anchors = _in_order([(j, at[x]) for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1 and x in at])
        left, low = a0, b0
        for j, i in anchors:
            out.append((i, j))
            todo.append((left, i, low, j))
            left, low = i + 1, j + 1
        if anchors:
            todo.append((left, a1, low, b1))
    return sorted(out, key=lambda pair: pair[1])


def _windows(lines: Sequence[int], words: Sequence[int], first: int, end: int) -> Iterator[tuple[int, int, tuple[int, int]]]:
    """``(begin, end, (size, hash))`` of the shortest windows of KEY_WORDS words that begin or end at each line."""
    sums, powers, total = [0], [1], [0]
    for x, n in zip(lines[first:end], words[first:end]):
        sums.append((sums[-1] * _BASE + x) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
        total.append(total[-1] + n)
    spans, high, low = set(), 0, 0
    for i in range(end - first):
        while high < end - first and total[high] - total[i] < KEY_WORDS:
            high += 1
        if total[high] - total[i] >= KEY_WORDS:
            spans.add((i, high))
        while total[i + 1] - total[low + 1] >= KEY_WORDS:
            low += 1
        if total[i + 1] - total[low] >= KEY_WORDS:
            spans.add((low, i + 1))
    for i, j in spans:
        yield first + i, first + j, (j - i, (sums[j] - sums[i] * powers[j - i]) % _PRIME)


def shared_windows(a: Sequence[int], b: Sequence[int], words: Sequence[int]) -> set[int]:
    """Lines of ``b`` in windows that ``a`` holds anywhere: the union of all equal blocks of KEY_WORDS words.

    Every line of such a block is in the window that begins at it or in the one that ends with the block.
    """

    def parts(lines: Sequence[int], other: set[int]) -> Iterator[tuple[int, int]]:
        begin = 0
        for i, x in enumerate(lines):
            if x not in other:
                yield begin, i
                begin = i + 1
        yield begin, len(lines)

    size = dict(zip(b, words))
    own = [size.get(x, 0) for x in a]
    held = {key for first, end in parts(a, set(b)) for *_, key in _windows(a, own, first, end)}
    turns = [0] * (len(b) + 1)  # windows that begin at a line, less those that end before it
    for first, end in parts(b, set(a)):
        for i, j, key in _windows(b, words, first, end):
            if key in held:
                turns[i] += 1
                turns[j] -= 1
    return {i for i, n in enumerate(accumulate(turns)) if n}


def aligned_lines(a: Sequence[int], b: Sequence[int], words: Sequence[int]) -> list[int]:
    """Lines of ``b`` in blocks, contiguous on both sides, of at least KEY_WORDS words: all such lines."""
    found: set[int] = set()
    todo = [(0, len(b))]
    while todo:
        first, end = todo.pop()
        if sum(words[first:end]) < KEY_WORDS:
            continue
        blocks: list[list[int]] = []  # start in b, end in b, end in a
        for i, j in patience(a, b, first, end):
            if blocks and blocks[-1][1] == j and blocks[-1][2] == i:
                blocks[-1][1:] = [j + 1, i + 1]
            else:
                blocks.append([j, j + 1, i + 1])
        blocks = [x for x in blocks if sum(words[x[0] : x[1]]) >= KEY_WORDS]
        if not blocks:
            continue
        for start, stop, _ in blocks:
            found.update(range(start, stop))
            todo.append((first, start))
            first = stop
        todo.append((first, end))
    own = set(a)
    if any(x in own and i not in found for i, x in enumerate(b)):
        found |= shared_windows(a, b, words)
    return sorted(found)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [batch.column(c).to_pylist() for c in ("own_lines", "lines", "words")]
        found = [aligned_lines(a, b, w) for a, b, w in zip(*lists)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("mark"), pa.array(found, pa.list_(pa.int64()))], names=["row", "mark", "found"])


def _runs(positions: Column, words: Column, min_words: int) -> Column:
    """Runs ``(begin, end)`` of neighbouring positions that have at least ``min_words`` words."""
    runs = F.aggregate(
        F.sort_array(positions),
        F.array().cast("array<struct<begin:bigint,end:bigint,n:bigint>>"),
        lambda acc, p: F.when(
            (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] == p),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(F.get(acc, F.size(acc) - 1)["begin"].alias("begin"), (p + 1).alias("end"), (F.get(acc, F.size(acc) - 1)["n"] + F.get(words, p.cast("int"))).alias("n"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(p.alias("begin"), (p + 1).alias("end"), F.get(words, p.cast("int")).alias("n"))))),
    )
    return F.filter(runs, lambda r: r["n"] >= min_words)


def repeated_blocks(docs: DataFrame, row: str, text: str = "text", min_words: int = 20) -> DataFrame:
    """``(row, mark, runs)``: the runs of lines, ``begin`` to before ``end``, that earlier documents hold.

    ``mark`` is ``xxhash64`` of the text.
    """
    texts = docs.select(F.col(row).alias("row"), F.col(text).cast("string").alias("text")).filter("row is not null and text is not null")
    texts = texts.withColumn("mark", F.xxhash64("text"))
    outline = texts.mapInArrow(_outline, "row bigint, mark bigint, lines array<bigint>, words array<bigint>, keys array<bigint>")
    outline = stage(outline, "outline")
    held = outline.select("row", "mark", F.explode("keys").alias("key"))
    owners = held.groupBy("key").agg(F.min(F.struct("row", "mark")).alias("own"), F.max(F.struct("row", "mark")).alias("last")).filter("own <> last")
    pairs = held.join(owners.select("key", "own"), "key").filter("struct(row, mark) <> own").select("row", "mark", "own").distinct()
    pairs = pairs.select("row", "mark", F.col("own.row").alias("own_row"), F.col("own.mark").alias("own_mark"))
    plain = outline.select("row", "mark", "lines", "words").dropDuplicates(["row", "mark"])
    first = plain.select(F.col("row").alias("own_row"), F.col("mark").alias("own_mark"), F.col("lines").alias("own_lines"))
    met = pairs.join(first, ["own_row", "own_mark"]).join(plain, ["row", "mark"])
    found = met.select("row", "mark", "lines", "words", "own_lines").mapInArrow(_align, "row bigint, mark bigint, found array<bigint>")
    lines = found.filter("size(found) > 0").groupBy("row", "mark").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
    runs = lines.join(plain.select("row", "mark", "words"), ["row", "mark"]).select("row", "mark", _runs(F.col("found"), F.col("words"), min_words).alias("runs"))
    return runs.filter("size(runs) > 0")


def drop_repeated_blocks(docs: DataFrame, row: str, text: str = "text", min_words: int = 20) -> DataFrame:
    """``docs`` with those lines cut from ``text``, and the cut ``runs`` of lines in ``__runs`` (null: none)."""
    cuts = stage(repeated_blocks(docs, row, text, min_words), "cuts").toDF("__row", "__mark", "__runs")
    joined = docs.join(
        bounded(cuts), (docs[row] == F.col("__row")) & (F.xxhash64(docs[text].cast("string")) == F.col("__mark")), "left"
    )
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.exists("__runs", lambda r: (i >= r["begin"]) & (i < r["end"])))
    shorter = F.when(F.col("__runs").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[shorter.alias(c) if c == text else joined[c] for c in docs.columns], "__runs")
