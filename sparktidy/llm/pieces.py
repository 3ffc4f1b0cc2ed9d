"""SentencePiece encoding and decoding by suffix-array matching.

A batch is cut where no piece can reach across (before white space, around line breaks and characters
that no piece holds) and each distinct chunk is encoded once; a bounded number is remembered for the next batch.  The new chunks are concatenated and their
suffixes sorted to the length of the longest piece; every piece of the model is binary-searched, which
gives the range of all its occurrences.  The occurrences are edges, sorted by where they end, and are
relaxed from left to right: in a BPE encoding each prefix of a chunk has exactly one last piece, the one
that stands next to the last piece of what is before it just as when the two are encoded alone.  So an
edge is kept if its pair with the piece kept at its start is such a pair; pairs are decided once and
remembered.  The result is that of merging by score, ids included.

Spaces become U+2581 and one is put in front, as the model asks; characters outside the model become
their UTF-8 bytes.  Decoding reverses this, so a text comes back unless it holds U+2581 itself.  Null
texts have null ids, empty ones none.  Only models of kind BPE with byte fallback, a dummy prefix and no
other normalisation are taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._text import give_back, row_slices

SPACE = "▁"
SLICE = 1 << 19
PAIRS_KEPT = 1_000_000
CHUNKS_KEPT = 120_000
IDS_KEPT = 800_000
_SLOTS = 1 << 20
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


class _Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class PieceModel:
    """Pieces and scores; what encoding learns about pairs stays with it for the next batch."""

    def __init__(self, pieces: Sequence[str], scores: Sequence[float], byte_ids: Sequence[int], special: Sequence[int]):
        self.pieces, self.byte_ids = list(pieces), np.array(byte_ids, np.int64)
        hidden = set(special) | set(byte_ids)
        self.id_of = {p: i for i, p in enumerate(pieces) if i not in hidden}
        self.score = dict(zip(range(len(pieces)), scores))
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.id_of):
            raise ValueError("a piece reaches across white space")
        alphabet = sorted({c for p in self.id_of for c in p})
        missing = [c for c in alphabet if c not in self.id_of]
        if missing:
            raise ValueError(f"characters that are no pieces: {missing[:5]}")
        self.code = np.zeros(0x110000, np.uint16)  # 0: in no piece
        self.code[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.depth = max(map(len, self.id_of))
        ordered = sorted(self.id_of.items())
        self.ids = np.array([i for _, i in ordered], np.int64)
        self.length = np.ones(len(pieces) + 1, np.int64)
        self.length[self.ids] = [len(p) for p, _ in ordered]
        self.spelling = np.zeros((len(ordered), self.depth), np.uint16)  # codes, 0 after the end
        for k, (p, _) in enumerate(ordered):
            self.spelling[k, : len(p)] = self.code[[ord(c) for c in p]]
        self.text = [p.replace(SPACE, " ").encode() for p in pieces]
        for value, i in enumerate(byte_ids):
            self.text[i] = bytes([value])
        for i in special:
            self.text[i] = b""
        self._start()

    def _start(self) -> None:
        self.pairs, self.holds = np.zeros(0, np.int64), np.zeros(0, bool)
        self.recent, self.recent_holds = np.full(_SLOTS, -1, np.int64), np.zeros(_SLOTS, bool)
        self._forget()

    def __getstate__(self) -> dict:
        """The model alone; what it has learnt stays with the process."""
        learnt = ("pairs", "holds", "recent", "recent_holds", "index", "known_ids", "known_begin")
        return {name: value for name, value in self.__dict__.items() if name not in learnt}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def _forget(self) -> None:
        self.index = _Numbered()
        self.known_ids, self.known_begin = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def merge(self, text: str) -> list[int]:
        """Encoding of a short text by merging the best neighbours, the leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                return [self.id_of[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stands(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the encoding of both together is just these two; ``before`` = number of pieces: nothing."""
        size = len(self.pieces) + 1
        pair = before * size + piece
        slot = (pair ^ (pair >> 20)) & (_SLOTS - 1)
        out = self.recent_holds[slot]
        missed = np.flatnonzero(self.recent[slot] != pair)
        if len(missed):
            out[missed] = self._look_up(pair[missed])
            self.recent[slot[missed]], self.recent_holds[slot[missed]] = pair[missed], out[missed]
            # of two pairs that share a slot, the one whose name stayed there must have its own answer
            clash = missed[self.recent[slot[missed]] != pair[missed]]
            self.recent[slot[clash]] = -1
        return out

    def _look_up(self, pair: np.ndarray) -> np.ndarray:
        size = len(self.pieces) + 1
        at = np.searchsorted(self.pairs, pair)
        fresh = np.ones(len(pair), bool)
        if len(self.pairs):
            fresh = self.pairs[np.minimum(at, len(self.pairs) - 1)] != pair
        if fresh.any():
            if len(self.pairs) > PAIRS_KEPT:  # what is still needed is found anew
                self.pairs, self.holds = np.zeros(0, np.int64), np.zeros(0, bool)
                return self._look_up(pair)
            new = np.unique(pair[fresh])
            holds = []
            for b, p in zip((new // size).tolist(), (new % size).tolist()):
                holds.append(self.merge((self.pieces[b] if b < size - 1 else "") + self.pieces[p]) == ([b, p] if b < size - 1 else [p]))
            place = np.searchsorted(self.pairs, new)
            self.pairs, self.holds = np.insert(self.pairs, place, new), np.insert(self.holds, place, holds)
            at = np.searchsorted(self.pairs, pair)
        return self.holds[at]

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, piece)`` of every occurrence, from the sorted suffixes."""
        present = np.unique(codes)
        present = present[present > 0]
        dense = np.zeros(int(self.code.max()) + 1, np.uint64)
        dense[present] = np.arange(1, len(present) + 1)
        # the characters of this batch, several to a word
        bits = 8 if len(present) < 255 else 16
        per_word = 64 // bits
        usable = (dense[self.spelling] > 0).sum(axis=1) == self.length[self.ids]
        ids, size = self.ids[usable], self.length[self.ids[usable]]
        spelled = dense[self.spelling[usable]]
        known = np.flatnonzero(codes)
        padded = np.concatenate([dense[codes], np.zeros(self.depth + per_word, np.uint64)])
        rank, prefix = np.zeros(len(known), np.int64), np.zeros(len(ids), np.int64)
        exact = np.ones(len(ids), bool)
        low, high = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        full = np.uint64((1 << bits) - 1)
        deepest = int(size.max(initial=1))
        for first in range(0, deepest, per_word):
            word, least, most = np.zeros(len(known), np.uint64), np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint64)
            for k in range(first, first + per_word):
                shift = np.uint64(bits)
                word = (word << shift) | padded[known + k]
                inside = k < size
                own = spelled[:, k] if k < self.depth else np.zeros(len(ids), np.uint64)
                least = (least << shift) | own
                most = (most << shift) | np.where(inside, own, full)
            words, rank_of_word = np.unique(word, return_inverse=True)
            key = (rank << 32) | rank_of_word
            ordered = np.sort(key)
            ends = exact & (size > first) & (size <= first + per_word)
            begin = prefix[ends] << 32
            low[ends] = np.searchsorted(ordered, begin | np.searchsorted(words, least[ends], "left"))
            high[ends] = np.searchsorted(ordered, begin | np.searchsorted(words, most[ends], "right"))
            if first + per_word < deepest:  # longer pieces must have this whole word
                place = np.minimum(np.searchsorted(words, least), len(words) - 1)
                keys, rank = np.unique(key, return_inverse=True)
                code = (prefix << 32) | place
                at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
                exact &= (size > first + per_word) & (words[place] == least) & (keys[at] == code)
                prefix = at
        order = np.argsort(key)
        count = high - low
        at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return known[order[at]], np.repeat(ids, count)

    def encode_chunks(self, chunks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks after each other, and where those of each begin (one more entry)."""
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(c) for c in chunks])
        # a gap after each chunk, so that no piece reaches into the next one
        begin = np.cumsum(size + 1) - size - 1
        place = np.arange(len(points)) + np.repeat(np.arange(len(chunks)), size)
        codes = np.zeros(len(points) + len(chunks), np.uint16)
        codes[place] = self.code[points]
        nothing = len(self.pieces)
        start, piece = self.edges(codes)
        outside = place[codes[place] == 0]
        start, piece = np.append(start, outside), np.append(piece, np.full(len(outside), nothing))
        end = start + self.length[piece]
        chunk_of = np.searchsorted(begin, start, side="right") - 1
        level = end - begin[chunk_of]
        order = np.argsort(level.astype(np.uint16) if level.max(initial=0) < 1 << 16 else level, kind="stable")
        start, piece, end, level = start[order], piece[order], end[order], level[order]
        last = np.full(len(codes) + 1, -1, np.int64)
        last[begin] = nothing
        cuts = np.flatnonzero(np.diff(level)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(level))):
            before, own = last[start[a:b]], piece[a:b]
            keep = own == nothing
            asked = np.flatnonzero((before >= 0) & ~keep)
            keep[asked] = self.stands(before[asked], own[asked])
            last[end[a:b][keep]] = own[keep]
        # back from the end of each chunk, all chunks at once
        at, owner, taken = begin + size, np.arange(len(chunks)), []
        while len(at):
            own = last[at]
            taken.append((owner, own, at))
            at = at - self.length[own]
            more = at > begin[owner]
            at, owner = at[more], owner[more]
        owner, own, at = (np.concatenate(x) for x in zip(*taken))
        order = np.lexsort((at, owner))
        owner, own, at = owner[order], own[order], at[order]
        lost = np.flatnonzero(own == nothing)
        if len(lost):  # characters outside the model: their bytes
            back = np.full(len(codes) + 1, 0, np.uint32)
            back[place] = points
            spelled = [self.byte_ids[list(chr(p).encode("utf-8", "surrogatepass"))] for p in back[at[lost] - 1]]
            times = np.ones(len(own), np.int64)
            times[lost] = [len(x) for x in spelled]
            first = np.cumsum(times) - times
            own, owner = np.repeat(own, times), np.repeat(owner, times)
            own[np.repeat(first[lost], times[lost]) + np.concatenate([np.arange(len(x)) for x in spelled])] = np.concatenate(spelled)
        return own, np.searchsorted(owner, np.arange(len(chunks) + 1))

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, and where those of each begin (one more entry)."""
        if len(self.index) > CHUNKS_KEPT or len(self.known_ids) > IDS_KEPT:
            self._forget()
        index, known = self.index, len(self.index)
        parts: list[int] = []
        count = []
        for text in texts:
            found = _CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else []
            parts.extend(map(index.__getitem__, found))
            count.append(len(found))
        if len(index) > known:
            ids, begin = self.encode_chunks(list(islice(index, known, None)))
            self.known_begin = np.append(self.known_begin, begin[1:] + len(self.known_ids))
            self.known_ids = np.append(self.known_ids, ids)
        part = np.array(parts, np.int64)
        first = self.known_begin[part]
        size = self.known_begin[part + 1] - first if len(part) else np.zeros(0, np.int64)
        flat = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(count, dtype=np.int64))]
        return self.known_ids[flat], ends

    def decode(self, ids: Sequence[int]) -> str:
        text = b"".join([self.text[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def load_model(path: str) -> PieceModel:
    """Pieces and scores of a model file, which the driver reads."""
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    size = file.get_piece_size()
    pieces = [file.id_to_piece(i) for i in range(size)]
    byte_ids = [i for i in range(size) if file.is_byte(i)]
    byte_ids.sort(key=lambda i: int(pieces[i][3:5], 16))
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte fallback")
    special = [i for i in range(size) if file.is_control(i) or file.is_unknown(i) or file.is_unused(i)]
    return PieceModel(pieces, [file.get_score(i) for i in range(size)], byte_ids, special)


def _share(df: DataFrame, model: PieceModel):
    return df.sparkSession.sparkContext.broadcast({"pickled": cloudpickle.dumps(model)})


def _open(shared) -> PieceModel:
    """The model, kept by a worker process with what it has learnt."""
    held = shared.value
    if "model" not in held:
        held["model"] = cloudpickle.loads(held["pickled"])
        del held["pickled"]
    return held["model"]


def _encode(shared, text: str, keep: list[str], check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        model = _open(shared)
        for batch in batches:
            for part in row_slices(batch, text, SLICE):
                texts = part.column(text)
                ids, ends = model.encode(texts.to_pylist())
                mask = texts.is_null() if texts.null_count else None
                columns = [*map(part.column, keep), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=mask)]
                if check:
                    rows = zip(texts, ends, ends[1:])
                    columns.append(pa.array((model.decode(ids[a:b].tolist()) == t.as_py() if t.is_valid else None for t, a, b in rows), pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", *["round_trip"] * check])
            # else what a batch freed adds up over a long task
            give_back()

    return run


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _open(shared)
        for batch in batches:
            texts = [model.decode(row.values.to_pylist()) if row.is_valid else None for row in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)


def encode(df: DataFrame, model: PieceModel, text: str = "text", keep: list[str] | None = None, check: bool = False) -> DataFrame:
    """``keep`` (all columns by default) with ``ids``; with ``check`` also ``round_trip``, whether decoding
    them in the same pass gives the text back.  Columns of these names are replaced."""
    keep = [c for c in (keep if keep is not None else df.columns) if c.lower() not in ("ids", "round_trip")]
    shared, rows = _share(df, model), df.select(*keep)
    held = text in keep and dict(rows.dtypes)[text] == "string"  # a kept text is sent once
    sent = rows if held else df.select(*keep, F.col(text).cast("string").alias("__text"))
    return sent.mapInArrow(_encode(shared, text if held else "__text", keep, check), f"{_fields(rows)}, ids array<int>" + ", round_trip boolean" * check)


def decode(df: DataFrame, model: PieceModel) -> DataFrame:
    """The columns with ``decoded``, the text of ``ids``."""
    shared = _share(df, model)
    rows = df.drop("decoded")
    return rows.mapInArrow(_decode(shared), f"{_fields(rows)}, decoded string")
