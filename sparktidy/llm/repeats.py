"""Exact substring dedup: remove every byte covered by a string of ``length`` bytes that occurs twice.

A suffix array of the whole corpus decides it, but only few suffixes have to be sorted:

* **Anchors.** In each window of ``length`` bytes the 64 bytes of the smallest hash are its anchor (the
  leftmost on a tie).  Equal windows have their anchor at the same place, so windows are compared
  anchor by anchor.  An anchor stands for the run of windows that choose it; the bytes that these
  windows cover are its context.  An anchor whose 64 bytes occur once cannot repeat and is dropped
  after an exchange of hashes; contexts that occur twice as a whole repeat in all their windows.
* **Suffixes.** What is left are unlike contexts of a common anchor, each once.  Their suffixes, which
  begin at the anchor, are sorted in small runs, front-coded (shared prefix length and rest) and
  exchanged; a loser tree merges the runs of a partition.  It keeps, for each loser, the prefix that it
  shares with the string that beat it, so no known prefix is compared again, and it yields the common
  prefix of neighbours.
* **Windows.** Two windows that begin ``j`` bytes before their anchors are equal if the suffixes share
  ``length - j`` bytes and the ``j`` bytes before them are equal.  Over the sorted suffixes of an anchor
  the first is an interval for each ``j``, the second a prefix hash.

An anchor with more than ``GROUP`` unlike contexts is not sorted in one task; the hashes of all its
windows are grouped instead, which gives the same result.

Contexts are told apart by 128-bit hashes.  Null texts are empty.  Matches never cross texts.  Equal
rows are two places, so they repeat each other; rows of one id with unlike texts are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._text import byte_values, inverse_powers, mix, powers, row_slices, utf8
from sparktidy.workspace import stage

LENGTH = 400
KEY = 64
GROUP = 4096
PER_PART = 40_000
PIECE = 1 << 22
_VALUES = (byte_values(1), byte_values(2))
_LOW = np.uint64(0xFFFFFFFF)


def _prefix_sums(data: np.ndarray, which: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.append(np.uint64(0), np.cumsum(_VALUES[which][data] * powers(len(data)), dtype=np.uint64))


def _spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (sums[end] - sums[start]) * inverse_powers(len(sums))[start]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours (van Herk): block minima from the left and from the right."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, key: int = KEY) -> dict[str, np.ndarray]:
    """One entry per anchor: ``start`` of its first window and ``more`` windows after it, ``off`` from there to
    the anchor, hash ``kh`` of the anchor's bytes, ``c1`` and ``c2`` of the context."""
    n = len(data)
    if n < length:
        return {c: np.zeros(0, np.int64) for c in ("start", "more", "off", "kh", "c1", "c2")}
    sums = [_prefix_sums(data, which) for which in (0, 1)]
    at = np.arange(n - key + 1)
    hashes = mix(_spans(sums[0], at, at + key), 1)
    least = _sliding_min((hashes & ~_LOW) | at.astype(np.uint64), length - key + 1)
    valid = np.zeros(n + 1, np.int32)
    fits = np.diff(offsets) >= length
    valid[offsets[:-1][fits]] += 1
    valid[offsets[1:][fits] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(valid[: n - length + 1]))
    chosen = (least[starts] & _LOW).astype(np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    start, anchor = starts[first], chosen[first]
    more = np.diff(np.append(first, len(starts))) - 1
    off = anchor - start
    shape = mix(off.astype(np.uint64) * np.uint64(1 << 32) + more.astype(np.uint64), 3)
    contexts = [mix(_spans(s, start, start + more + length) ^ shape, 4 + i) for i, s in enumerate(sums)]
    return {"start": start, "more": more, "off": off, "kh": hashes[anchor], "c1": contexts[0], "c2": contexts[1]}


_ANCHOR = "row bigint, mark bigint, start bigint, more int, off int, kh bigint, c1 bigint, c2 bigint"


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                data, offsets = utf8(part.column("text"))
                # a very long text comes alone; cut into pieces that overlap by all but one byte of a window
                for begin in range(0, max(len(data), 1), PIECE) if len(part) == 1 else (0,):
                    piece = data[begin : begin + PIECE + length - 1] if len(part) == 1 else data
                    found = anchors(piece, offsets if len(part) > 1 else np.array([0, len(piece)]), length)
                    doc = np.searchsorted(offsets, found["start"] + begin, side="right") - 1
                    ids = [part.column(c).take(pa.array(doc)) for c in ("row", "mark")]
                    columns = [
                        *ids,
                        pa.array(found["start"] + begin - offsets[doc]),
                        pa.array(found["more"].astype(np.int32)),
                        pa.array(found["off"].astype(np.int32)),
                        *(pa.array(found[c].view(np.int64)) for c in ("kh", "c1", "c2")),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "mark", "start", "more", "off", "kh", "c1", "c2"])

    return run


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are not looked at."""
    end, step = min(len(a), len(b)), 16
    while known < end and a[known : known + step] == b[known : known + step]:
        known, step = min(known + step, end), step * 2
    high = min(known + step, end)
    while known < high:
        middle = (known + high + 1) // 2
        if a[known:middle] == b[known:middle]:
            known = middle
        else:
            high = middle - 1
    return known


def front_code(strings: Sequence[bytes]) -> tuple[list[int], list[bytes]]:
    """Sorted strings as shared prefix lengths and rests."""
    shared, before = [], b""
    for s in strings:
        shared.append(common_prefix(before, s))
        before = s
    return shared, [s[n:] for s, n in zip(strings, shared)]


def merge_runs(runs: Sequence[tuple[Sequence[int], Sequence[bytes]]]) -> Iterator[tuple[int, int, bytes, int]]:
    """Merge front-coded sorted runs: ``(run, position, string, prefix shared with the string before)``.

    A loser tree: the entry of a run is its next string and the prefix it shares with the last string
    that went past the entry's node.  The longer shared prefix wins without looking at the strings.
    """
    width = 1
    while width < len(runs):
        width *= 2
    position, current, shared = [0] * width, [b""] * width, [0] * width
    alive = [False] * width
    for r, (_, rests) in enumerate(runs):
        if len(rests):
            alive[r], current[r] = True, rests[0]

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix becomes that with the winner."""
        if not alive[x] or not alive[y]:
            return (x, y) if alive[x] else (y, x)
        if shared[x] != shared[y]:
            return (x, y) if shared[x] > shared[y] else (y, x)
        a, b = current[x], current[y]
        n = common_prefix(a, b, shared[x])
        first = (x, y) if n == len(a) or (n < len(b) and a[n] < b[n]) else (y, x)
        shared[first[1]] = n
        return first

    losers = [0] * width
    winners = [0] * width + list(range(width))
    for node in range(width - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    while alive[best]:
        yield best, position[best], current[best], shared[best]
        prefixes, rests = runs[best]
        position[best] += 1
        if position[best] < len(rests):
            n = prefixes[position[best]]
            current[best], shared[best] = current[best][:n] + rests[position[best]], n
        else:
            alive[best] = False
        node = (best + width) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


def repeated_starts(lefts: Sequence[bytes], shared: np.ndarray, off: np.ndarray, more: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For sorted suffixes of one anchor the repeated windows of each context, as runs of starts.

    ``lefts`` are the bytes before the anchors, ``shared`` the common prefixes of neighbouring suffixes.
    """
    g = len(lefts)
    if g == 2:
        before = common_prefix(lefts[0][::-1], lefts[1][::-1])
        found = []
        for o, m in zip(off, more):
            low, high = max(length - int(shared[0]), int(o - m)), min(before, int(o))
            found.append([(int(o) - high, int(o) - low)] if low <= high else [])
        return found
    widest = int(off.max())
    js = np.arange(int((off - more).min()), widest + 1)
    reversed_left = np.zeros((g, widest), np.uint8)
    for i, left in enumerate(lefts):
        reversed_left[i, : len(left)] = np.frombuffer(left, np.uint8)[::-1]
    with np.errstate(over="ignore"):
        prefix = np.zeros((widest + 1, g), np.uint64)
        np.cumsum((_VALUES[0][reversed_left] * powers(widest)).T, axis=0, out=prefix[1:])
        interval = np.zeros((len(js), g), np.uint64)
        interval[:, 1:] = np.cumsum(shared[None, :] < (length - js)[:, None], axis=1)
        names = mix(prefix[js] + interval * np.uint64(0xD6E8FEB86659FD93), 9)
    valid = (js[:, None] <= off[None, :]) & (js[:, None] >= (off - more)[None, :])
    # contexts that lack the window get names of their own
    names[~valid] = mix(np.flatnonzero(~valid.ravel()).astype(np.uint64), 10)
    order = np.argsort(names, axis=1, kind="stable")
    ordered = np.take_along_axis(names, order, axis=1)
    equal = ordered[:, 1:] == ordered[:, :-1]
    twice = np.zeros_like(valid)
    twice[:, 1:] |= equal
    twice[:, :-1] |= equal
    repeated = np.zeros_like(valid)
    np.put_along_axis(repeated, order, twice, axis=1)
    repeated &= valid
    found = []
    for i in range(g):
        starts = np.sort(off[i] - js[repeated[:, i]])
        found.append(_as_runs(starts))
    return found


def _as_runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Ascending numbers as runs ``(first, last)``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist()))


_RUN = "part bigint, shared array<int>, rests array<binary>, lefts array<binary>, off array<int>, more array<int>, c1 array<bigint>, c2 array<bigint>, copies array<bigint>"
_FOUND = "c1 bigint, c2 bigint, runs array<struct<first:bigint,last:bigint>>"


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch, for each partition: the suffixes sorted and front-coded."""
    kinds = {"shared": pa.int32(), "rests": pa.binary(), "lefts": pa.binary(), "off": pa.int32(), "more": pa.int32(), "c1": pa.int64(), "c2": pa.int64(), "copies": pa.int64()}
    for batch in batches:
        rows = batch.to_pydict()
        by_part: dict[int, list[int]] = {}
        for i, part in enumerate(rows["part"]):
            by_part.setdefault(part, []).append(i)
        out: dict[str, list] = {"part": [], **{k: [] for k in kinds}}
        for part, own in by_part.items():
            suffix = {i: rows["context"][i][rows["off"][i] :] for i in own}
            own.sort(key=suffix.__getitem__)
            shared, rests = front_code([suffix[i] for i in own])
            out["part"].append(part)
            out["shared"].append(shared)
            out["rests"].append(rests)
            out["lefts"].append([rows["context"][i][: rows["off"][i]] for i in own])
            for c in ("off", "more", "c1", "c2", "copies"):
                out[c].append([rows[c][i] for i in own])
        yield pa.RecordBatch.from_arrays([pa.array(out["part"], pa.int64()), *(pa.array(out[c], pa.list_(k)) for c, k in kinds.items())], names=["part", *kinds])


def _merge_part(length: int, key: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        found: dict[str, list] = {"c1": [], "c2": [], "runs": []}

        def close(group: list[tuple[int, int, int]]) -> None:
            pick = lambda c: np.array([rows[c][r][p] for r, p, _ in group], np.int64)
            copies = pick("copies")
            if len(group) < 2 or (copies > 1).all():
                return
            lefts = [rows["lefts"][r][p] for r, p, _ in group]
            starts = repeated_starts(lefts, np.array([n for *_, n in group[1:]], np.int64), pick("off"), pick("more"), length)
            for c1, c2, n, runs in zip(pick("c1").tolist(), pick("c2").tolist(), copies, starts):
                if n == 1 and runs:
                    found["c1"].append(c1)
                    found["c2"].append(c2)
                    found["runs"].append([{"first": a, "last": b} for a, b in runs])

        group: list[tuple[int, int, int]] = []
        for r, p, _, shared in merge_runs(list(zip(rows["shared"], rows["rests"]))):
            if shared < key:
                close(group)
                group = []
            group.append((r, p, shared))
        close(group)
        run_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        return pa.table({"c1": pa.array(found["c1"], pa.int64()), "c2": pa.array(found["c2"], pa.int64()), "runs": pa.array(found["runs"], run_type)})

    return run


def _window_hashes(length: int):
    """``(h1, h2, c1, c2, at)`` of every window of a context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c1, c2, context in zip(*(batch.column(c).to_pylist() for c in ("c1", "c2", "context"))):
                data = np.frombuffer(context, np.uint8)
                at = np.arange(len(data) - length + 1)
                hashes = [mix(_spans(_prefix_sums(data, w), at, at + length), 20 + w).view(np.int64) for w in (0, 1)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, hashes), pa.array(np.full(len(at), c1)), pa.array(np.full(len(at), c2)), pa.array(at)], names=["h1", "h2", "c1", "c2", "at"])

    return run


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    for batch in batches:
        runs = [[{"first": a, "last": b} for a, b in _as_runs(np.sort(np.array(x)))] for x in batch.column("at").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("c1"), batch.column("c2"), pa.array(runs, kind)], names=["c1", "c2", "runs"])


def repeated_windows(texts: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``(row, mark, begin, end)`` of repeated strings of at least ``length`` bytes in ``(row, mark, text)``."""
    found = stage(texts.filter(F.octet_length("text") >= length).mapInArrow(_find_anchors(length), _ANCHOR), "anchors")
    name = F.struct("c1", "c2")
    unlike = (F.min("c1") != F.max("c1")) | (F.min("c2") != F.max("c2"))
    # a table of its own, so that the adaptive join can split a frequent anchor
    keys = stage(found.groupBy("kh").agg(F.count(F.lit(1)).alias("places"), unlike.alias("unlike")).filter("places > 1"), "anchor-keys")
    repeated = stage(found.join(keys.select("kh", "unlike"), "kh"), "repeated-anchors")
    contexts = repeated.groupBy("c1", "c2", "kh", "unlike", "off", "more").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "mark", "start")).alias("place"))
    contexts = stage(contexts, "contexts")
    mixed = contexts.filter("unlike").groupBy("kh").agg(F.count(F.lit(1)).alias("members"), F.min("copies").alias("fewest"))
    mixed = stage(mixed.filter("fewest = 1"), "mixed-anchors")
    todo = contexts.join(mixed.select("kh", "members"), "kh").select("kh", "members", "c1", "c2", "off", "more", "copies", "place.*")
    count = todo.count()
    parts = max(1, -(-count // PER_PART))
    # rows with a null id are found by the null-safe comparison
    source = texts.toDF("t_row", "t_mark", "text")
    todo = todo.join(source, todo.row.eqNullSafe(source.t_row) & (todo.mark == source.t_mark))
    cut = F.substring(F.col("text").cast("binary"), (F.col("start") + 1).cast("int"), F.col("more") + length)
    todo = todo.select("members", F.pmod("kh", F.lit(parts)).alias("part"), "off", "more", "c1", "c2", "copies", cut.alias("context"))
    todo = stage(todo, "suffixes")
    runs = todo.filter(F.col("members") <= group).drop("members").mapInArrow(_sorted_runs, _RUN)
    sorted_out = runs.groupBy("part").applyInArrow(_merge_part(length, KEY), _FOUND)
    windows = todo.filter(F.col("members") > group).select("c1", "c2", "context").mapInArrow(_window_hashes(length), "h1 bigint, h2 bigint, c1 bigint, c2 bigint, at bigint")
    twice = windows.groupBy("h1", "h2").agg(F.min(name).alias("low"), F.max(name).alias("high")).filter("low <> high").select("h1", "h2")
    grouped = windows.join(twice, ["h1", "h2"]).groupBy("c1", "c2").agg(F.collect_list("at").alias("at")).mapInArrow(_join_runs, _FOUND)
    whole = contexts.filter("copies > 1").select("c1", "c2", F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("more").cast("bigint").alias("last"))).alias("runs"))
    known = stage(sorted_out.unionByName(grouped), "found").unionByName(whole).withColumnRenamed("runs", "windows")
    met = repeated.select("row", "mark", "start", "c1", "c2").join(known, ["c1", "c2"])
    spans = met.select("row", "mark", "start", F.explode("windows").alias("w"))
    return spans.select("row", "mark", (F.col("start") + F.col("w.first")).alias("begin"), (F.col("start") + F.col("w.last") + length).alias("end"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, count = [], [], []
        for text, spans in zip(batch.column("__text").to_pylist(), batch.column("__spans").to_pylist()):
            at, out, cuts = 0, [], 0
            end_before = -1
            for begin, end in sorted((s["begin"], s["end"]) for s in spans or []):
                if begin > end_before:
                    cuts += 1
                out.append(text[at:begin])  # empty where spans overlap
                at, end_before = max(at, end), max(end_before, end)
            out.append(text[at:])
            kept.append(b"".join(out))
            removed.append(len(text) - len(kept[-1]))
            count.append(cuts)
        others = [i for i, c in enumerate(batch.schema.names) if c not in ("__text", "__spans")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in others), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64())],
            names=[*(batch.schema.names[i] for i in others), "kept", "n_removed", "n_spans"],
        )


def remove_repeats(docs: DataFrame, row: str, text: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``row``, ``kept`` (the remaining bytes), ``n_removed`` and ``n_spans`` (maximal removed runs) of every row."""
    texts = docs.select(F.col(row).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    texts = texts.select("row", F.xxhash64("text").alias("mark"), "text")
    spans = repeated_windows(texts, length, group).groupBy("row", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("__spans")).toDF("s_row", "s_mark", "__spans")
    joined = texts.join(spans, texts.row.eqNullSafe(spans.s_row) & (texts.mark == spans.s_mark), "left")
    kind = docs.select(F.col(row).alias("row")).schema[0].dataType.simpleString()
    return joined.select("row", F.col("text").cast("binary").alias("__text"), "__spans").mapInArrow(
        _remove, f"row {kind}, kept binary, n_removed bigint, n_spans bigint"
    ).withColumnRenamed("row", row)
