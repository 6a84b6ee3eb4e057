"""Connected components by alternating large-star and small-star steps, each a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, _row_bytes, attach
from windrow.session import durable


def _star(edges: DataFrame, small: bool, few: bool) -> DataFrame:
    """One step over rows (a, b) with a > b.

    Large star: every neighbour above a node is tied to the least of the node and its neighbours.
    Small star: a node and its neighbours below are tied to the least of those. The least ones are
    sent to all tasks where there are ``few`` links; else a node with very many links is spread.
    """
    if small:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        tied = attach(edges, least, ["a"], "inner", ["b"], few).select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
    else:
        both = edges.select(F.explode(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        tied = attach(both.filter(F.col("v") > F.col("u")), least, ["u"], "inner", ["v"], few).select(
            F.struct(F.col("v").alias("a"), F.col("m").alias("b")).alias("e"))
    return tied.select("e.*").filter(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``, root being the least node it is joined to.

    Nodes are of any ordered type. Links to itself, repeated and reversed links change nothing;
    links with a null end are left out. Stops when a round changes no link; the number of rounds
    grows with the logarithm of the longest chain. Every round is checkpointed.
    """
    ends = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = durable(ends.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                    .filter(F.col("a") > F.col("b")).distinct())
    mark = _mark(edges)
    size = edges.agg(F.coalesce(F.sum(_row_bytes(edges)), F.lit(0))).first()[0]
    while True:
        # a step makes no links but only moves them: there are never more nodes than two per link
        few = 2 * mark[0] <= BROADCAST_ROWS and size <= BROADCAST_BYTES
        edges = durable(_star(_star(edges, False, few), True, few))
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number of links and two sums of their hashes: equal exactly when the links are."""
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        F.sum(F.xxhash64("b", F.lit(7), "a").cast("decimal(38,0)"))).first())
