"""Connected components by alternating stars, with only grouped minima and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookhouse.llm.scratch import discard, keep


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) reaches.

    A large star moves each node's larger neighbours to its smallest one, a small star its smaller neighbours; rounds
    grow with the logarithm of the longest chain. Loops (a = b) and edges with a NULL end add no node.
    """
    edges = keep(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and u <> v").distinct()
    )
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # one row holds both edges that a small star makes of (u, v): v to m, and u to m
        small = large.join(least, "u").select(
            F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        ).where("u <> v").distinct()
        after = keep(small)
        now = _state(after)
        discard(edges)
        edges = after
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Number of edges and sum of their hashes: equal before and after a round only if the round changed nothing."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
