"""Connected components of an edge table, as alternating large and small stars.

Every step is a minimum per node (summed per task first) joined back to the
edges, written to the shared checkpoint folder; no neighbour list is ever
built, so a node with very many edges costs no more than its rows, and
adaptive execution may split it in the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm import scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges ``(u, v)`` with ``u > v``.

    Large: every greater neighbour of a node moves to the node's least
    neighbour (or itself). Small: a node and its lesser neighbours move to
    the least of them."""
    if large:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(
            F.col("w").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        lesser = edges.join(least, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        moved = lesser.unionByName(least.withColumnRenamed("m", "v"))
    return moved.where(F.col("u") != F.col("v")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)`` (64-bit integers):
    the root is the least node of its component; roots map to themselves.
    Loops and repeated edges are ignored; no edges give no rows."""
    links = scratch.stored(
        edges.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    digest = _digest(links)
    while digest[0]:
        links = scratch.stored(_star(_star(links, large=True), large=False), "edges")
        before, digest = digest, _digest(links)
        if digest == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
