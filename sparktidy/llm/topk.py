"""Exact top-k by inner product: columnar branch-and-bound.

Vectors are packed into blocks stored dimension by dimension (vertical layout).  A task takes one
block of queries and one of candidates, accumulates the products a few dimensions at a time, and
after each of these steps compacts the candidates that can still reach the k best: what the
remaining dimensions can add is at most the product of the remaining lengths (Cauchy-Schwarz).
The first steps, which rule out few, are taken for many queries at once.
Partial results of the blocks, k per query, are merged by a grouped aggregate.

All arithmetic is on integers below 2^53, where doubles are exact; larger ones use Python integers.
Vectors that are null, hold a null or a non-finite component, or have another length than the query's
take no part.  Equal scores go to the smaller id.  Rows that repeat an id stay separate candidates of
other queries; a query id that comes with several vectors is answered once, for the smallest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktidy.llm._frames import bounded
from sparktidy.workspace import stage

BLOCK = 2048
STEP = 16
TILE = 256  # queries
PART_CELLS = 1 << 23  # components of the queries that a task holds at once
PAIRS = 1 << 26  # of vectors that a task of their own is worth
FEW = 16  # tasks that may have a sixteenth of that
_PACKED = "dims int, part int, rows binary, ids binary, cells binary, width int"
_WIDTHS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}


def whole_numbers(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component as double; null unless all components are finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # doubles from 2^44 on are whole once multiplied, and floor() would not fit a long
    scaled = lambda x: x * F.lit(float(factor))
    floors = F.transform(doubles, lambda x: F.when(F.abs(x) < 2.0**44, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    return F.when(usable, floors)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of at most BLOCK vectors of one length and part, dimension by dimension, in the narrowest type that holds them."""
    schema = pa.schema([("dims", pa.int32()), ("part", pa.int32()), ("rows", pa.binary()), ("ids", pa.binary()), ("cells", pa.binary()), ("width", pa.int32())])
    waiting: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

    def block(key: tuple[int, int]) -> pa.RecordBatch:
        rows, ids, cells = (np.concatenate(x) for x in zip(*waiting.pop(key)))
        cells = cells.reshape(len(ids), key[0])
        most = np.abs(cells).max(initial=0.0)
        width = next((w for w in (1, 2, 4) if most < 2.0 ** (8 * w - 1)), 8)
        layout = np.ascontiguousarray(cells.T, dtype=_WIDTHS[width])
        return pa.record_batch([[key[0]], [key[1]], [rows.tobytes()], [ids.tobytes()], [layout.tobytes()], [width]], schema=schema)

    for batch in batches:
        names, ids, parts = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 3))
        lists = batch.column(2)
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        begin = np.cumsum(size) - size
        for dims, part in np.unique(np.stack([size, parts], axis=1), axis=0).tolist():
            rows, key = np.flatnonzero((size == dims) & (parts == part)), (dims, part)
            for some in np.array_split(rows, -(-len(rows) // BLOCK)):
                at = begin[some][:, None] + np.arange(dims)
                waiting.setdefault(key, []).append((names[some], ids[some], flat[at].ravel()))
                if sum(len(i) for i, *_ in waiting[key]) >= BLOCK:
                    yield block(key)
    for key in list(waiting):
        yield block(key)


def _rest(cells: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Length of what remains of each vector from each cut on, rounded up."""
    return np.stack([np.sqrt((cells[c:] ** 2).sum(axis=0)) * (1 + 1e-12) + 1e-9 for c in cuts])


def best_of_block(query: np.ndarray, cells: np.ndarray, ahead: np.ndarray, first: int, rest: np.ndarray, query_rest: np.ndarray, cuts: list[int], k: int, barred: np.ndarray, known: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the candidates that may be among the k best, ties included.

    ``ahead`` has the products over the dimensions before cut ``first``, ``known`` is the k-th best score of
    earlier blocks.
    """
    alive = np.flatnonzero((ahead + query_rest[first] * rest[first] >= known) & ~barred)
    total = ahead[alive]
    for step in range(first, len(cuts)):
        if len(alive) > k:
            slack = query_rest[step] * rest[step][alive]
            floor = max(known, np.partition(total - slack, len(alive) - k)[len(alive) - k])
            keep = total + slack >= floor
            alive, total = alive[keep], total[keep]
        if step + 1 < len(cuts):
            total = total + query[cuts[step] : cuts[step + 1]] @ cells[cuts[step] : cuts[step + 1]][:, alive]
    return alive, total


_FOUND = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


def _search(k: int):
    schema = pa.schema([(n, pa.int64()) for n in ("query_row", "query_id", "row", "vec_id", "score")])

    def load(dims: int, rows: bytes, ids: bytes, cells: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(cells, _WIDTHS[width]).reshape(dims, -1).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}  # of each block of queries met in this task, the k best scores so far
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                dims = row["dims"]
                q_rows, q_ids, q = load(dims, row["q_rows"], row["q_ids"], row["q_cells"], row["q_width"])
                c_rows, c_ids, c = load(dims, row["rows"], row["ids"], row["cells"], row["width"])
                exact = dims * np.abs(q).max(initial=0.0) * np.abs(c).max(initial=0.0) < 2.0**53
                cuts = [*range(0, dims, STEP), dims] if exact else [0, dims]
                rest, query_rest = _rest(c, cuts), _rest(q, cuts)
                top = best.setdefault(row["block"], np.full((len(q_ids), k), -np.inf))
                out = []
                first = max(1, 3 * (len(cuts) - 1) // 4)  # the first steps rule out few, so many queries take them at once
                for i, own in enumerate(q_rows):
                    if exact:
                        if i % TILE == 0:
                            ahead = q[: cuts[first], i : i + TILE].T @ c[: cuts[first]]
                        at, score = best_of_block(q[:, i], c, ahead[i % TILE], first, rest, query_rest[:, i], cuts, k, c_rows == own, top[i].min())
                        if not len(at):
                            continue
                        order = np.lexsort((c_rows[at], c_ids[at], -score))[:k]
                        top[i] = np.sort(np.concatenate([top[i], score[order]]))[-k:]
                    else:  # integers beyond doubles; a score beyond 64 bits is an error, as in SQL
                        at = np.flatnonzero(c_rows != own)
                        ints = [int(x) for x in q[:, i]]
                        score = np.array([sum(a * int(b) for a, b in zip(ints, c[:, j])) for j in at], dtype=object)
                        order = sorted(range(len(at)), key=lambda j: (-score[j], c_ids[at[j]], c_rows[at[j]]))[:k]
                    out += [(int(own), int(q_ids[i]), int(c_rows[at[j]]), int(c_ids[at[j]]), int(score[j])) for j in order]
                columns = list(zip(*out)) or [[]] * len(schema)
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, schema.types)], schema=schema)

    return run


def _grid(rows: int, asked: int, cells: int, tasks: int) -> tuple[int, int]:
    """Into how many parts the queries are cut, and into how many shards all rows.

    Each task takes a part and a shard, so the rows are copied once for each part and the queries once for
    each shard, where each finds its k best.  With these numbers the copies of both take about the same
    room, for as many tasks as there are, or fewer if that is little work for them.
    """
    pairs = rows * asked
    tasks = max(1, min(tasks, max(pairs // PAIRS, min(FEW, 16 * pairs // PAIRS))))
    parts = max(1, -(-cells // PART_CELLS), round(math.sqrt(2 * tasks * asked / max(rows, 1))))
    return parts, -(-tasks // parts)


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", factor: int = 256) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query row's ``k`` largest inner products with all other rows.

    Every row is a query and a candidate of its own, also one of a repeated id or vector.  Queries are cut
    into parts and all rows into shards, and each shard meets each part by a shuffle, never a broadcast, so
    neither side has to fit anywhere as a whole; the k-th score found so far prunes the next blocks of a
    task.  Rows without an id, empty vectors and an empty table have no part; further columns are dropped.
    """
    spark = vectors.sparkSession
    usable = vectors.select(F.col(vec_id).cast("bigint").alias("id"), whole_numbers(F.col(vector), factor).alias("v"), is_query.alias("q"))
    usable = stage(usable.filter("id is not null and v is not null and size(v) > 0").withColumn("row", F.monotonically_increasing_id()), "vectors")
    rows, asked, cells = usable.agg(F.count(F.lit(1)), F.count_if("q"), F.coalesce(F.sum(F.when(F.col("q"), F.size("v"))), F.lit(0))).first()
    parts, shards = _grid(rows, asked, cells, int(spark.conf.get("spark.sql.shuffle.partitions")))
    queries = usable.filter("q").select("row", "id", "v", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part")).mapInArrow(_pack, _PACKED)
    queries = queries.selectExpr("dims", "part", "rows q_rows", "ids q_ids", "cells q_cells", "width q_width", "monotonically_increasing_id() block")
    queries = stage(queries, "query-blocks")
    # the parts that have queries of a length
    numbers = bounded(queries.groupBy("dims").agg(F.collect_set("part").alias("parts")))
    candidates = usable.select("row", "id", "v", F.lit(0).alias("part")).mapInArrow(_pack, _PACKED).drop("part").withColumn("shard", F.pmod(F.xxhash64("rows"), F.lit(shards)).cast("int"))
    pairs = candidates.join(numbers, "dims").withColumn("part", F.explode("parts")).drop("parts")
    # the optimizer takes the copies for no larger than one of them, and would broadcast them
    copies = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).hint("merge")
    found = pairs.join(copies, ["dims", "part", "shard"]).mapInArrow(_search(k), _FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
