"""Connected groups of nodes that share buckets, without listing the pairs of a bucket.

Candidate pairs are nodes in one bucket. Most links of a large bucket are found
by checking its members against one pivot; groups found so far are then merged,
and only pairs across different groups are left to check. They are met inside a
join condition, so a pair that a cheap exact bound rules out is never a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.llm.common import written


def _directed(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): component is the smallest node reachable.

    Alternates large-star and small-star until the edges no longer change. Each round is a
    grouped minimum and an equi-join on a node; its edges are written to the shared folder.
    """

    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    # a is the larger node of an edge, b the smaller.
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")
    before = state(edges)
    while before[0]:
        both = _directed(edges)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = written(small.distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _pairs_named(members: DataFrame, side: str) -> DataFrame:
    return members.select(*[F.col(c).alias(f"{side}_{c}") for c in members.columns])


def linked(
    members: DataFrame,
    rank: Column,
    possible: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    confirm: Callable[[DataFrame], DataFrame],
    rounds: int = 2,
) -> DataFrame:
    """(node, component) of the nodes that have a link.

    ``members``: a written table of bucket, node (bigint) and facts of the node, one row per bucket and node.
    ``rank`` chooses the pivot of a bucket in the first round (the least); later rounds take others.
    ``possible(x, y)`` is an exact necessary condition for a link, from facts ``x("fact")`` and ``y("fact")``
    of the two. ``confirm`` gets pairs (a, b) and returns those that are links. However many rounds of
    pivots there are, every pair of a bucket that is still in two groups is met in the end.
    """
    facts = [c for c in members.columns if c not in ("bucket", "node")]
    x, y = (lambda c: F.col(f"x_{c}")), (lambda c: F.col(f"y_{c}"))
    across = (x("group") != y("group")) & possible(x, y)
    groups = None

    def open_buckets() -> DataFrame:
        """Members of buckets that hold several groups; a node without a link is a group of its own."""
        if groups is None:
            return members.withColumn("group", F.col("node"))
        now = members.join(groups.withColumnRenamed("component", "group"), "node", "left").withColumn("group", F.coalesce("group", "node"))
        several = now.groupBy("bucket").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("bucket")
        return written(now.join(several, "bucket").select("bucket", "node", *facts, "group"), "open-buckets")

    def merge(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.greatest("x_node", "y_node").alias("a"), F.least("x_node", "y_node").alias("b")).distinct()
        found = confirm(pairs)
        if groups is not None:  # a group found before stands in for its links
            found = found.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
        return written(components(found), "groups")

    for turn in range(rounds):
        held = open_buckets()
        order = F.struct(rank if turn == 0 else F.xxhash64("node", F.lit(turn)), *[F.col(c) for c in ("node", *facts, "group")])
        pivots = held.groupBy("bucket").agg(F.min(order).alias("p")).select(F.col("bucket").alias("x_bucket"), *[F.col(f"p.{c}").alias(f"y_{c}") for c in ("node", *facts, "group")])
        groups = merge(_pairs_named(held, "x").join(pivots, "x_bucket").where(across))
    held = open_buckets()
    met = _pairs_named(held, "x").join(_pairs_named(held, "y"), (x("bucket") == y("bucket")) & (x("node") < y("node")) & across)
    return merge(met)
