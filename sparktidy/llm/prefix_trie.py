"""The trie of conversations: every common beginning once, with its members.

Conversations are cut into blocks of ``BLOCK`` turns.  They are grouped by the digests of successive
blocks first, so a group of any size is one row from then on; boundaries between turns are refined
only inside blocks where siblings, blocks after the same beginning, diverge.  A digest is two 64-bit
sums (exclusive or) of hashes of the turns with their positions, so beginnings are running sums.

Sums over subtrees need no walk along the levels: each node belongs to the path of its smallest
member, paths hang on nodes of other paths, and the totals of paths are added up by pointer doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktidy.operators.numbering import number_rows
from sparktidy.workspace import stage

BLOCK = 4  # turns
STRIDE = 1024  # rows of a running sum within one window
IDS = 4096  # conversation ids in one piece of a list of ends


def number_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, at, mark, chars)``: position from 0, digest and code points of every turn.

    Turns go by ``turn``, nulls first, rows of one turn by digest; equal rows are turns of their own.  A
    null role or text is empty, rows of a null conversation take no part, further columns are dropped.
    """
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    mark = F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said).cast("binary"))
    small = turns.filter(F.col(conv).isNotNull()).select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), mark.alias("mark"), F.length(said).cast("bigint").alias("chars"))
    numbered = number_rows(small, [F.col("turn").asc_nulls_first(), F.col("mark")], "at", 0, ["conv"])
    return numbered.select("conv", F.col("at").cast("bigint").alias("at"), "mark", "chars")


def _running(df: DataFrame, key: str, index: str, columns: dict[str, Column], combine, inclusive: bool) -> DataFrame:
    """Adds running totals over ``index``, a dense number, within ``key``.

    Strides are summed in a window of their own, then the totals of strides: no window holds more than
    a stride of rows or the strides of one key.
    """
    last = Window.currentRow if inclusive else -1
    df = df.withColumn("__stride", F.expr(f"{index} div {STRIDE}"))
    inner = Window.partitionBy(key, "__stride").orderBy(index).rowsBetween(Window.unboundedPreceding, last)
    zero = F.lit(0).cast("bigint")
    out = df.select("*", *[F.coalesce(combine(c).over(inner), zero).alias(f"__in_{n}") for n, c in columns.items()])
    # empty unless a key has more rows than a stride
    long = df.filter("__stride <> 0").select(key).distinct()
    totals = df.join(long, key, "left_semi").groupBy(key, "__stride").agg(*[combine(c).alias(n) for n, c in columns.items()])
    outer = Window.partitionBy(key).orderBy("__stride").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(key, "__stride", *[combine(F.col(n)).over(outer).alias(f"__out_{n}") for n in columns])
    both = out.join(before, [key, "__stride"], "left")
    plus = (lambda a, b: a.bitwiseXOR(b)) if combine is F.bit_xor else (lambda a, b: a + b)
    return both.select(*[c for c in df.columns if c != "__stride"], *[plus(F.col(f"__in_{n}"), F.coalesce(f"__out_{n}", zero)).alias(n) for n in columns])


def _boundaries(blocks: DataFrame) -> DataFrame:
    """A row for each turn of each block: the digest through it and before it."""
    zero = F.lit(0).cast("bigint")

    def through(n: Column, which: str) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), n), zero, lambda a, t: a.bitwiseXOR(t[which]))

    rows = F.transform(
        "turns",
        lambda t, i: F.struct(
            (F.col("b") * BLOCK + i + 1).alias("depth"),
            F.col("p1").bitwiseXOR(through(i + 1, "h1")).alias("d1"),
            F.col("p2").bitwiseXOR(through(i + 1, "h2")).alias("d2"),
            F.col("p1").bitwiseXOR(through(i, "h1")).alias("q1"),
            F.col("p2").bitwiseXOR(through(i, "h2")).alias("q2"),
            t["chars"].alias("chars"),
        ),
    )
    return blocks.select("n", "c", F.explode(rows).alias("r")).select("r.*", "n", "c")


def _ends(finals: DataFrame) -> DataFrame:
    """sha256 of the ascending ids that end at each node, in pieces that a task hashes one by one."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = finals.groupBy("depth", "d1", "d2", F.floor(F.col("conv") / F.lit(IDS)).alias("piece")).agg(ids.alias("ids"))
    width = int(finals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.repartition(width, "depth", "d1", "d2").sortWithinPartitions("depth", "d1", "d2", "piece")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            done = []
            for key, ids in zip(zip(*[batch.column(c).to_pylist() for c in ("depth", "d1", "d2")]), batch.column("ids").to_pylist()):
                if key == node:
                    running.update(b",")
                else:
                    if node is not None:
                        done.append((*node, running.hexdigest()))
                    node, running = key, hashlib.sha256()
                running.update(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(_ENDS.names, d)) for d in done], _ENDS)
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(_ENDS.names, (*node, running.hexdigest())))], _ENDS)

    return ordered.select("depth", "d1", "d2", "ids").mapInArrow(hashes, "depth bigint, d1 bigint, d2 bigint, ends string")


_ENDS = pa.schema([("depth", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("ends", pa.string())])


def _path_totals(tops: DataFrame, sums: DataFrame) -> DataFrame:
    """What each path holds with all that hang on it; ``anc`` is the path it hangs on, null for the root's."""
    state, own = stage(tops.join(sums, "c"), "paths"), [c for c in tops.columns if c not in ("c", "anc")]
    while True:
        # pointer doubling: a path adds what hangs on it at the distance reached, then the distance doubles
        add = state.filter("anc is not null").groupBy("anc").agg(F.sum("w").alias("w_add"), F.sum("leaves").alias("l_add")).withColumnRenamed("anc", "c")
        hop = state.select(F.col("c").alias("anc"), F.col("anc").alias("next"))
        state = state.join(add, "c", "left").join(hop, "anc", "left")
        state = state.select("c", *own, (F.col("w") + F.coalesce("w_add", F.lit(0))).alias("w"), (F.col("leaves") + F.coalesce("l_add", F.lit(0))).alias("leaves"), F.col("next").alias("anc"))
        state = stage(state, "paths")
        if state.filter("anc is not null").isEmpty():
            return state.drop("anc")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv, at, mark, chars)`` and all ``(conv)`` -> one row per distinct beginning.

    ``conv`` is the smallest member, which with ``depth`` names a node; ``parent`` that of the parent (null
    at the root), ``n_convs`` the members, ``n_children``, ``n_leaves`` the childless nodes and ``saved`` the
    code points that members share, summed over the subtree; ``ends`` the sha256 of the ids that end there.
    ``at`` is dense from 0 within a conversation; one without turns ends at the root.  No conversation,
    no row.
    """
    zero = F.lit(0).cast("bigint")
    convs = stage(convs.select("conv").filter("conv is not null").distinct(), "convs")
    root = convs.agg(F.min("conv").alias("c"), F.count(F.lit(1)).alias("n")).first()
    tagged = turns.select("conv", "at", "chars", F.xxhash64("mark", "at").alias("h1"), F.xxhash64(F.lit(BLOCK), "at", "mark").alias("h2"))
    own = F.array_sort(F.collect_list(F.struct("at", "h1", "h2", "chars")))
    blocks = stage(tagged.groupBy("conv", F.expr(f"at div {BLOCK}").alias("b")).agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), own.alias("turns")), "blocks")
    chained = _running(blocks, "conv", "b", {"p1": F.col("x1"), "p2": F.col("x2")}, F.bit_xor, inclusive=False)

    # whole blocks first: a group of equal conversations is one row
    grouped = chained.groupBy("b", "p1", "p2", "x1", "x2").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("c"), F.first("turns").alias("turns"))
    grouped = stage(grouped, "block-nodes")
    diverging = grouped.groupBy("b", "p1", "p2").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("b", "p1", "p2", F.lit(True).alias("split"))
    # all first blocks follow the same, empty beginning: one literal instead of a hot key
    first = F.lit(True) if not diverging.filter("b = 0").isEmpty() else F.lit(None).cast("boolean")
    later = grouped.filter("b > 0").join(diverging, ["b", "p1", "p2"], "left")
    marked = stage(later.unionByName(grouped.filter("b = 0").withColumn("split", first)), "marked")
    whole = _boundaries(marked.filter("split is null"))
    fine = _boundaries(marked.filter("split")).groupBy("depth", "d1", "d2", "q1", "q2", "chars").agg(F.sum("n").alias("n"), F.min("c").alias("c"))
    nodes = stage(whole.unionByName(fine), "nodes")

    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("d1"), F.col("q2").alias("d2")).agg(F.count(F.lit(1)).alias("n_children"))
    top = convs.sparkSession.range(1).select(zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), F.lit(None).cast("bigint").alias("q1"), F.lit(None).cast("bigint").alias("q2"), zero.alias("chars"), F.lit(root.n).cast("bigint").alias("n"), F.lit(root.c).cast("bigint").alias("c"))
    every = nodes.unionByName(top.filter("n > 0"))
    tree = stage(every.join(kids, ["depth", "d1", "d2"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "tree")
    above = tree.filter("depth > 0 and n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("q1"), F.col("d2").alias("q2"), F.col("c").alias("parent"))
    near_root = tree.filter("depth <= 1").withColumn("parent", F.when(F.col("depth") == 1, F.lit(root.c)).cast("bigint"))
    tree = tree.filter("depth > 1").join(above, ["depth", "q1", "q2"], "left").unionByName(near_root)
    tree = tree.withColumn("w", (F.col("n") - 1) * F.col("chars")).withColumn("leaf", (F.col("n_children") == 0).cast("bigint"))
    tree = stage(tree.drop("q1", "q2", "chars"), "tree")

    # every node is on the path of its smallest member; the path of the root's is where all hang in the end
    below = tree.filter(F.col("c") != F.lit(root.c)) if root.n else tree
    tops = below.filter("parent <> c").select("c", F.nullif("parent", F.lit(root.c)).alias("anc"), F.col("parent").alias("up"), (F.col("depth") - 1).alias("up_depth"))
    paths = _path_totals(tops, below.groupBy("c").agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaves")))
    hanging = paths.groupBy(F.col("up").alias("c"), F.col("up_depth").alias("depth")).agg(F.sum("w").alias("w_below"), F.sum("leaves").alias("l_below"))
    full = tree.join(hanging, ["c", "depth"], "left")
    full = full.withColumn("w", F.col("w") + F.coalesce("w_below", zero)).withColumn("leaf", F.col("leaf") + F.coalesce("l_below", zero)).drop("w_below", "l_below")
    # from the end of a path upwards
    upward = stage(full.withColumn("back", -F.col("depth")), "upward")
    summed = _running(upward, "c", "back", {"saved": F.col("w"), "n_leaves": F.col("leaf")}, F.sum, inclusive=True)

    finals = convs.select("conv", zero.alias("m"), zero.alias("x1"), zero.alias("x2")).unionByName(blocks.select("conv", F.size("turns").cast("bigint").alias("m"), "x1", "x2"))
    finals = finals.groupBy("conv").agg(F.sum("m").alias("depth"), F.bit_xor("x1").alias("d1"), F.bit_xor("x2").alias("d2"))
    out = summed.join(_ends(finals), ["depth", "d1", "d2"], "left")
    return out.select(F.col("c").alias("conv"), "depth", "parent", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved", F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends"))
