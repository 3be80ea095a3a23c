"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.runtime import store


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, part) for every node of the edges (a, b): part is the smallest node that can be reached.

    Alternates two steps until nothing changes: every node hands the smallest node it
    knows to its larger neighbours, then to its smaller ones. The number of rounds
    grows with the logarithm of the component size. Minima are aggregated before
    the shuffle, so a node with very many neighbours costs no more than others, and each
    round is a stored table, so a lost executor repeats one round at most.
    Self-links and repeated edges are allowed; nodes without another neighbour are left out.
    """
    edges = store(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while (state := _state(edges)) != before:
        before = state
        # Stored in between, since each step reads its links twice; links are told apart once a round, which keeps its shuffles few.
        edges = store(_to_smaller(store(_to_larger(edges))))
    # Now every edge leads from a node to the smallest of its component.
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("part")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("part")).union(roots)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint")), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _to_larger(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours get linked to the smallest node it knows; a link may come several times."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _to_smaller(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours get linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return linked.filter("a != b").distinct()
