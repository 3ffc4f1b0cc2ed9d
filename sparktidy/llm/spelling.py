"""Spelling variants: words that differ by one inserted, deleted or replaced character.

Words are arranged in a trie of letter counts: successive levels hold how often a word has each
group of letters.  A replaced character raises one count by one and lowers one other by one, an
inserted one only raises, a deleted one only lowers.  So a depth-first search that may spend a
surplus of one and a deficit of one meets every word one edit away; words at the leaves are verified.

Spark holds the trie in pieces.  The counts of its upper nodes are aggregated, nodes of more than
``piece`` words are split at the next level, and every word is stored in one piece and looked up in
each piece that its two units of budget can reach.  Pieces are groups of a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._text import row_slices, utf8
from sparktidy.workspace import stage

# One level for each of these letters, the dearest first; all other characters share the last levels.
LEVELS = "etaoinshrdlucmfwypvbgkqjxz"
OTHER = 6
WIDTH = len(LEVELS) + OTHER
TOP = 10  # levels at which a piece may end
PIECE = 10_000
PIECES = 10_000  # at most about so many; beyond, pieces grow
LONG = 48  # longer words are verified one by one
DENSE = 48  # nodes of so few classes are searched at once
CELLS = 2_000_000  # of a comparison in memory

_ASCII = np.arange(128) % OTHER + len(LEVELS)
_ASCII[[ord(c) for c in LEVELS]] = np.arange(len(LEVELS))


def _top_counts(words: pa.Array) -> np.ndarray:
    """Counts at the upper levels, up to 255."""
    return np.minimum(Vocabulary(words).counts[:, :TOP], 255).astype(np.uint8)


class Vocabulary:
    """Words as code points and letter counts."""

    def __init__(self, words: pa.Array):
        data, offsets = utf8(words)
        lead = (data & 0xC0) != 0x80
        ends = np.concatenate([[0], np.cumsum(lead)])[offsets]
        self.size = np.diff(ends)
        self.begin = ends[:-1]
        self.points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        of = np.repeat(np.arange(len(self.size)), self.size)
        level = np.where(self.points < 128, _ASCII[np.minimum(self.points, 127)], self.points % OTHER + len(LEVELS))
        self.counts = np.bincount(of * WIDTH + level, minlength=len(self.size) * WIDTH).reshape(-1, WIDTH).astype(np.int32)

    def padded(self, width: int) -> np.ndarray:
        """The first ``width`` code points of each word, padded by zeros."""
        out = np.zeros((len(self.size), width), np.uint32)
        size = np.minimum(self.size, width)
        row = np.repeat(np.arange(len(size)), size)
        column = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[row, column] = self.points[self.begin[row] + column]
        return out

    def word(self, i: int) -> np.ndarray:
        return self.points[self.begin[i] : self.begin[i] + self.size[i]]


def search(stored: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(stored row, wanted row, differ)`` of vectors a surplus and a deficit of one apart at most.

    Of two that differ, only the one that lacks a letter at their first unlike level finds the
    other, so each pair comes once.  ``stored`` is in lexicographic order, so that a node of the trie
    is a range of its rows.  All vectors that still have budget at a node go down together.
    """
    start = np.zeros(len(wanted), np.int8)
    weight = np.arange(WIDTH, 0, -1)
    stack = [(0, len(stored), 0, np.arange(len(wanted)), start, start)]
    while stack:
        lo, hi, level, who, more, less = stack.pop()
        if hi - lo <= DENSE or level == WIDTH:
            rest = stored[lo:hi, level:]
            step = max(1, CELLS // max(1, rest.size))
            for i in range(0, len(who), step):
                off = rest[None] - wanted[who[i : i + step], level:][:, None]
                rise = np.maximum(off, 0).sum(2)
                up, down = rise + more[i : i + step, None], rise - off.sum(2) + less[i : i + step, None]
                q, s = np.nonzero((up <= 1) & (down <= 1))
                # of a surplus and a deficit the heavier, that is the earlier, decides
                lead = np.where(more[i + q] > 0, 1, off[q, s] @ weight[level:])
                ok = lead >= 0
                yield s[ok] + lo, who[i + q[ok]], lead[ok] > 0
            continue
        column = stored[lo:hi, level]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1, [hi - lo]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            off = column[a] - wanted[who, level]
            up, down = more + np.maximum(off, 0), less + np.maximum(-off, 0)
            on = (up <= 1) & (down <= up)
            if on.any():
                stack.append((lo + a, lo + b, level + 1, who[on], up[on], down[on]))


def one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    off = np.flatnonzero(a != b[: len(a)])
    if len(a) == len(b):
        return len(off) == 1
    at = off[0] if len(off) else len(a)
    return bool((a[at:] == b[at + 1 :]).all())


def verified(stored: Vocabulary, wanted: Vocabulary, s: np.ndarray, q: np.ndarray, flat_s: np.ndarray, flat_q: np.ndarray) -> np.ndarray:
    """Which of the pairs are one edit apart."""
    out = np.zeros(len(s), bool)
    n, m = stored.size[s], wanted.size[q]
    long = np.maximum(n, m) > LONG
    for i in np.flatnonzero(long):
        out[i] = one_edit(stored.word(s[i]), wanted.word(q[i]))
    same = np.flatnonzero((n == m) & ~long)
    out[same] = (flat_s[s[same]] != flat_q[q[same]]).sum(1) == 1
    for i, short, wide in ((np.flatnonzero((n + 1 == m) & ~long), flat_s[s], flat_q[q]), (np.flatnonzero((m + 1 == n) & ~long), flat_q[q], flat_s[s])):
        if len(i):
            a, b = short[i], wide[i]
            differ = a != b
            first = np.where(differ.any(1), differ.argmax(1), a.shape[1])
            shifted = a[:, :-1] == b[:, 1:]
            out[i] = (shifted | (np.arange(a.shape[1] - 1) < first[:, None])).all(1)
    return out


def _classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct vectors in order, the rows by vector, and where the rows of each begin."""
    order = np.lexsort(counts.T[::-1])
    ranked = counts[order]
    fresh = np.ones(len(ranked), bool)
    fresh[1:] = (ranked[1:] != ranked[:-1]).any(1)
    return ranked[fresh], order, np.append(np.flatnonzero(fresh), len(ranked))


def _expanded(groups: np.ndarray, order: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of each group, and how many they are."""
    size = begin[groups + 1] - begin[groups]
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return order[np.repeat(begin[groups], size) + inner], size


class _Best:
    """For the words of one side: how many near words, and the best of the other side."""

    def __init__(self, words: int, n: np.ndarray):
        self.total, self.best = np.zeros(words, np.int64), np.full(words, -1)
        # the rank of a word of the other side by its count, then by code points
        self.order = np.lexsort((-np.arange(len(n)), n))
        self.place = np.empty(len(n), np.int64)
        self.place[self.order] = np.arange(len(n))

    def add(self, own: np.ndarray, other: np.ndarray) -> None:
        self.total += np.bincount(own, minlength=len(self.total))
        np.maximum.at(self.best, own, self.place[other])

    def rows(self, words: pa.Array, others: pa.Array, n: np.ndarray) -> pa.Table:
        found = np.flatnonzero(self.total)
        top = self.order[self.best[found]]
        return pa.table({"word": words.take(found), "near": self.total[found], "best": others.take(top), "best_n": n[top]}, schema=_NEAR)


def near_in_piece(table: pa.Table) -> pa.Table:
    """Near words between the words stored in a piece and those looked up in it."""
    is_stored = table.column("stored").to_numpy(zero_copy_only=False)
    sides = []
    for side in (table.filter(pa.array(is_stored)).sort_by("word"), table.filter(pa.array(~is_stored)).sort_by("word")):
        words = side.column("word").combine_chunks()
        sides.append((words, side.column("n").to_numpy(), Vocabulary(words)))
    (s_words, s_n, s_voc), (q_words, q_n, q_voc) = sides
    width = max(1, min(LONG, max([0, *s_voc.size, *q_voc.size]))) + 1
    flat_s, flat_q = s_voc.padded(width), q_voc.padded(width)
    s_class, s_order, s_begin = _classes(s_voc.counts)
    q_class, q_order, q_begin = _classes(q_voc.counts)
    of_s, of_q = _Best(len(s_words), q_n), _Best(len(q_words), s_n)

    def settle(s_groups: np.ndarray, q_groups: np.ndarray, differ: np.ndarray) -> None:
        left, size = _expanded(s_groups, s_order, s_begin)
        # each stored row of a pair of classes meets each wanted row of it
        times = np.repeat(q_begin[q_groups + 1] - q_begin[q_groups], size)
        first = np.repeat(np.repeat(q_begin[q_groups], size), times)
        inner = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        s, q, both = np.repeat(left, times), q_order[first + inner], np.repeat(np.repeat(differ, size), times)
        step = max(1, CELLS // width)
        for i in range(0, len(s), step):
            a, b, c = s[i : i + step], q[i : i + step], both[i : i + step]
            ok = verified(s_voc, q_voc, a, b, flat_s, flat_q)
            of_q.add(b[ok], a[ok])
            # words of one vector look each other up, unlike ones meet once
            ok &= c
            of_s.add(a[ok], b[ok])

    for s, q, differ in search(s_class, q_class) if len(s_class) and len(q_class) else ():
        pairs = (s_begin[s + 1] - s_begin[s]) * (q_begin[q + 1] - q_begin[q])
        cuts = np.searchsorted(np.cumsum(pairs), np.arange(CELLS, int(pairs.sum()) + CELLS, CELLS))
        for a, b in zip(np.concatenate([[0], cuts]), np.append(cuts, len(s))):
            if b > a:
                settle(s[a:b], q[a:b], differ[a:b])
    return pa.concat_tables([of_q.rows(q_words, s_words, s_n), of_s.rows(s_words, q_words, q_n)])


_NEAR = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])


class Top:
    """The upper trie as a table: ``child[node, count]``, -1 if none, and the blocks of each piece."""

    def __init__(self, sizes: dict[bytes, int], piece: int):
        keys = sorted(sizes, key=lambda k: (len(k), k))
        number = {k: i for i, k in enumerate(keys)}
        self.split = np.array([sizes[k] > piece and len(k) < TOP for k in keys], bool)
        # a piece that is too large at the last level is stored in blocks, and looked up in each
        self.blocks = np.array([-(-sizes[k] // piece) for k in keys], np.int64)
        self.child = np.full((len(keys), 257), -1, np.int32)
        for k in keys[1:]:
            self.child[number[k[:-1]], k[-1]] = number[k]

    def home(self, counts: np.ndarray) -> np.ndarray:
        """The piece that stores each vector."""
        at = np.zeros(len(counts), np.int32)
        for level in range(TOP):
            on = self.split[at]
            at[on] = self.child[at[on], counts[on, level]]
        return at

    def reached(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, piece)``: the pieces that a surplus of one, then a deficit of one reach."""
        row, at = np.arange(len(counts)), np.zeros(len(counts), np.int32)
        more, less, out = np.zeros(len(counts), bool), np.zeros(len(counts), bool), []
        for level in range(TOP + 1):
            open_ = self.split[at]
            out.append(np.stack([row[~open_], at[~open_]]))
            row, at, more, less = row[open_], at[open_], more[open_], less[open_]
            if not len(row):
                break
            own = counts[row, level].astype(np.int64)
            full = own == 255  # a count that ends here may hide the surplus
            yes = np.ones(len(row), bool)
            steps = []
            for value, can, up, down in ((own, yes, more, less), (own, full & ~more, yes, less), (np.minimum(own + 1, 255), ~more & ~full, yes, less), (np.maximum(own - 1, 0), more & ~less & (own > 0), more, yes)):
                to = self.child[at, value]
                ok = can & (to >= 0)
                steps.append((row[ok], to[ok], up[ok], down[ok]))
            row, at, more, less = (np.concatenate(x) for x in zip(*steps))
        row, at = np.unique(np.concatenate(out, axis=1), axis=1)
        return row, at


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n)`` with distinct words -> ``(word, near, best, best_n)`` of those with near words.

    ``near`` counts the words one edit away, ``best`` is the one of them with the largest ``n`` (ties:
    the smallest in code-point order).
    """
    words = stage(words.filter("word is not null").select("word", F.col("n").cast("bigint").alias("n")), "words")


    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, times = np.unique(_top_counts(batch.column("word")), axis=0, return_counts=True)
            for depth in range(TOP + 1):
                fresh = np.ones(len(found), bool)
                fresh[1:] = (found[1:, :depth] != found[:-1, :depth]).any(1)
                keys = np.ascontiguousarray(found[fresh, :depth])
                offsets = np.arange(len(keys) + 1, dtype=np.int32) * depth
                node = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(keys.tobytes())])
                n = np.add.reduceat(times, np.flatnonzero(fresh)) if len(keys) else times
                yield pa.RecordBatch.from_arrays([node, pa.array(n, pa.int64())], ["node", "n"])

    piece = max(PIECE, words.count() // PIECES)
    nodes = stage(words.select("word").mapInArrow(prefixes, "node binary, n bigint").groupBy("node").agg(F.sum("n").alias("n")), "trie-top")
    # at most TOP * words / piece nodes are heavy; these and their children are gathered
    heavy = nodes.filter(F.col("n") > piece).select(F.col("node").alias("parent"))
    parent = F.expr("substring(node, 1, length(node) - 1)")
    below = nodes.filter("length(node) > 0").join(F.broadcast(heavy), parent == F.col("parent"), "left_semi")
    top = Top({bytes(r.node): r.n for r in below.union(nodes.filter("length(node) = 0")).collect()}, piece)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words, counts = batch.column("word"), _top_counts(batch.column("word"))
            code = np.fromiter((crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words))
            home = top.home(counts)
            row, to = top.reached(counts)
            times = top.blocks[to]
            block = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            at = np.concatenate([np.arange(len(words)), np.repeat(row, times)])
            piece = np.concatenate([home, np.repeat(to, times)])
            block = np.concatenate([code % top.blocks[home], block])
            stored = np.arange(len(at)) < len(words)
            columns = [pa.array(piece, pa.int32()), pa.array(block, pa.int32()), words.take(pa.array(at)), batch.column("n").take(pa.array(at)), pa.array(stored)]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "block", "word", "n", "stored"])

    dealt = words.mapInArrow(deal, "piece int, block int, word string, n bigint, stored boolean")
    # a few pieces a task: they are small in bytes but not in work
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(top.blocks[~top.split].sum()) // 4)
    found = dealt.repartition(tasks, "piece", "block").groupBy("piece", "block").applyInArrow(near_in_piece, "word string, near bigint, best string, best_n bigint")
    # the larger count first, then the smaller word
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("top")).select("word", "near", "top.best", (-F.col("top.less")).alias("best_n"))


def spelling_groups(words: DataFrame, ratio: float = 2.0) -> DataFrame:
    """``(word, n)`` -> ``(word, form, root, n, n_near, form_n)``, one row per word.

    The form of a word is its near word of largest ``n`` (ties: the smallest in code-point order) if
    that is at least ``ratio`` times its own, else null; the root is where forms lead in the end, the
    word itself if it has none.  Rows of equal words are added up, null words take no part, further
    columns are dropped; an empty table gives an empty one.
    """
    if ratio <= 1:
        raise ValueError("a ratio of one or less lets forms run in circles")
    words = stage(words.filter("word is not null").groupBy("word").agg(F.sum("n").cast("bigint").alias("n")), "vocabulary")
    fits = F.col("best_n") >= F.col("n") * ratio
    formed = stage(
        words.join(near_words(words), "word", "left").select(
            "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n")
        ),
        "forms",
    )
    # a form is at least ratio times as frequent, so a path has few steps, and each round doubles them
    way = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        way = stage(way.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if way.filter("moved").isEmpty():
            break
        way = way.select("word", "root")
    joined = formed.join(way.select("word", "root"), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LATIN = 0xC3  # leads the two bytes of U+00C0 to U+00FF, and of nothing else


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc_of_runs(data: np.ndarray, begin: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, after what ``state`` has seen."""
    order = np.argsort(-size, kind="stable")
    begin, size, state = begin[order], size[order], ~state[order]
    for k in range(int(size[0]) if len(size) else 0):
        n = np.searchsorted(-size, -k)  # runs of more than k bytes
        if n <= 8:  # a few very long ones
            for i in range(n):
                state[i] = ~np.uint32(crc32(data[begin[i] + k : begin[i] + size[i]].tobytes(), int(~state[i])))
            break
        state[:n] = _CRC[(state[:n] ^ data[begin[:n] + k]) & 255] ^ (state[:n] >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = ~state
    return out


def letter_runs(texts: pa.Array, ids: list[object], least: int, every: int | None) -> pa.RecordBatch:
    """Distinct runs of letters with their counts; see :func:`word_counts`."""
    data, offsets = utf8(texts)
    data = _LOWER[data]
    lead = data == _LATIN
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.append(False, inside)[: len(inside) + 1]
    after = np.append(inside, False)
    begin, end = np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))
    points = (end - begin) - np.diff(np.append(0, np.cumsum(lead))[np.stack([begin, end])], axis=0)[0] if len(begin) else end
    keep = points >= least
    begin, end, points = begin[keep], end[keep], points[keep]
    extra = []
    if every:
        doc = np.searchsorted(offsets, begin, side="right") - 1
        seen = np.array([crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        tag = _crc_of_runs(data, begin, end - begin, seen[doc])
        changed = tag % every == 0
        for i in np.flatnonzero(changed):
            run = data[begin[i] : end[i]].tobytes().decode()
            at = int(tag[i]) % len(run)
            if len(run) > least:
                extra.append(run[:at] + run[at + 1 :])
        begin, end = begin[~changed], end[~changed]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[begin] += 1
    mark[end] -= 1
    chars = data[np.cumsum(mark[:-1]) > 0]
    sizes = np.append(0, np.cumsum(end - begin)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(sizes), pa.py_buffer(chars.tobytes())])
    counted = pa.concat_arrays([runs, pa.array(extra, pa.string())]).value_counts()
    return pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], ["word", "n"])


def word_counts(docs: DataFrame, text: str = "text", least: int = 5, delete_by: str | None = None, every: int = 97) -> DataFrame:
    """``(word, n)``: how often each run of at least ``least`` letters occurs in all texts.

    Letters are A-Z, lower-cased, a-z and U+00C0 to U+00FF as they are; null texts have none.  With a
    column ``delete_by`` known variants are planted: of a run whose crc32 of ``<id>:<run>`` is a multiple
    of ``every``, the code point at that crc32 modulo its length goes (a null id is an empty one).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                yield letter_runs(part.column("text"), part.column("id").to_pylist() if delete_by else [], least, every if delete_by else None)

    ids = F.col(delete_by).cast("string") if delete_by else F.lit(None).cast("string")
    runs = docs.select(F.col(text).alias("text"), ids.alias("id")).mapInArrow(count, "word string, n bigint")
    return runs.groupBy("word").agg(F.sum("n").alias("n"))
