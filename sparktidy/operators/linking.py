"""Record linking: rows sharing any complete key set belong together, transitively.

Rows that agree on a key set form a star around the smallest row id, so there are at most
``rows x key sets`` edges and never a pair list.  Components are found by contraction: in each round
every node joins the first node of its neighbourhood, joined nodes become one, and edges are relabelled
to them.  The first round goes by row id, which folds the stars of the keys, however large; later rounds
go by a hash that changes with the round, so that a path of any order shrinks by a constant factor and
the rounds are logarithmic in its length (Bögeholz, Brand and Todor, "In-database connected component
analysis", ICDE 2020).  Edges are pairs of 64-bit ids; each round has fewer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.operators.skew import key_marks, lookup_per_key
from sparktidy.workspace import Rounds, stage


def star_edges(df: DataFrame, key_set: Sequence[str], row_id: str) -> DataFrame:
    """``(child, parent)``: each row of a shared key to the smallest row id of that key."""
    marks = ["__mark1", "__mark2"]
    complete = df.select(row_id, *key_set).dropna(subset=list(key_set)).select(row_id, *key_marks(key_set, marks))
    hubs = (
        complete.groupBy(*marks)
        .agg(F.min(row_id).alias("__hub"), F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1")
    )
    return (
        lookup_per_key(complete, stage(hubs, "hubs"), marks, weight="__n", spread_by=row_id)
        .filter(F.col(row_id) > F.col("__hub"))
        .select(F.col(row_id).alias("child"), F.col("__hub").alias("parent"))
    )


def _rank(node: Column, round_no: int) -> Column:
    return node if round_no == 0 else F.xxhash64(node, F.lit(round_no))


def joined_nodes(edges: DataFrame, round_no: int) -> DataFrame:
    """``(node, into, n)``: nodes that join another one, with the number of their edges."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("child").alias("node"), F.col("parent").alias("other")), F.struct(F.col("parent").alias("node"), F.col("child").alias("other")))).alias("e"))
    first = F.min(F.struct(_rank(F.col("e.other"), round_no).alias("rank"), F.col("e.other").alias("into")))
    chosen = ends.groupBy(F.col("e.node").alias("node")).agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.struct(F.col("first.rank"), F.col("first.into")) < F.struct(_rank(F.col("node"), round_no), F.col("node"))
    return chosen.filter(earlier).select("node", F.col("first.into").alias("into"), "n")


def contracted(edges: DataFrame, joins: DataFrame) -> DataFrame:
    """The edges between the nodes that are left; what has become one node has none."""
    for end, other in (("child", "parent"), ("parent", "child")):
        moved = lookup_per_key(edges, joins.withColumnRenamed("node", end), [end], weight="n", spread_by=other)
        edges = moved.select(F.coalesce("into", end).alias(end), other)
    different = edges.filter("child <> parent")
    return different.select(F.greatest("child", "parent").alias("child"), F.least("child", "parent").alias("parent")).distinct()


def connected_stars(edges: DataFrame) -> DataFrame:
    """``(child, parent)`` edges -> ``(child, smallest node of its component)``."""
    spark = edges.sparkSession
    left = Rounds(spark, "edges")
    edges = left.keep(edges.filter("child > parent").distinct())
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        rounds.append(stage(joined_nodes(edges, len(rounds)), "joins"))
        edges = left.keep(contracted(edges, rounds[-1]))
        left.drop_all_but(1)
    left.drop_all_but(0)
    if not rounds:
        return spark.createDataFrame([], "child bigint, parent bigint")
    # where nodes are in the end: the last rounds, with the fewest nodes, first
    whole = Rounds(spark, "places")
    places = rounds.pop().select("node", "into")
    while rounds:
        before = rounds.pop()
        sizes = places.select(F.col("node").alias("into"), F.col("into").alias("onward"))
        sent = before.select("node", "into").join(sizes, "into", "left")
        # a node that joined in this round may have lent its name to others that it took in
        later = places.join(before.select("node"), "node", "left_anti")
        places = whole.keep(sent.select("node", F.coalesce("onward", "into").alias("into")).unionByName(later))
        whole.drop_all_but(1)
    # a node whose name stands for a component may have been told where it went, or not
    members = places.unionByName(places.select(F.col("into").alias("node"), "into")).distinct()
    smallest = members.groupBy("into").agg(F.min("node").alias("parent"), F.count(F.lit(1)).alias("n"))
    ends = lookup_per_key(members, stage(smallest, "smallest"), ["into"], weight="n", spread_by="node").select(F.col("node").alias("child"), "parent")
    return stage(ends.filter("child <> parent"), "stars")


def link_labels(df: DataFrame, key_sets: Sequence[Sequence[str]], row_id: str) -> DataFrame:
    """``(row_id, group_id, group_size)`` for the rows that are linked to at least one other row."""
    edges = reduce(DataFrame.unionAll, [star_edges(df, keys, row_id) for keys in key_sets])
    stars = connected_stars(edges)
    sizes = stage(stars.groupBy("parent").agg((F.count(F.lit(1)) + 1).alias("group_size")), "sizes")
    children = lookup_per_key(
        stars, sizes, ["parent"], weight="group_size", spread_by="child"
    ).select(F.col("child").alias(row_id), F.col("parent").alias("group_id"), "group_size")
    hubs = sizes.select(F.col("parent").alias(row_id), F.col("parent").alias("group_id"), "group_size")
    return children.unionByName(hubs)


def link_records(df: DataFrame, key_sets: Sequence[Sequence[str]], row_id: str) -> DataFrame:
    """``df`` with ``group_id`` (smallest row id of the group) and ``group_size``.

    A key set with any null links nothing; an unlinked row is a group of its own.
    """
    labels = link_labels(df, key_sets, row_id)
    return (
        df.join(labels, row_id, "left")
        .withColumn("group_id", F.coalesce("group_id", row_id))
        .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("bigint")))
    )


def oversized_groups(linked: DataFrame, max_size: int) -> DataFrame:
    """Groups above ``max_size``, for review: one shared junk key can chain unrelated rows."""
    return (
        linked.groupBy("group_id")
        .agg(F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > max_size)
    )
