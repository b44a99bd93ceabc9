"""Connected components of a table of edges, without gathering any component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import released, written


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node. The result reads one
    written table, which the caller may release.

    Alternates two steps until nothing changes: every node ties its larger neighbours to its smallest one, then its
    smaller neighbours and itself. Neighbourhoods are only ever reduced to a minimum and joined with it, so a node
    with many neighbours is spread like any other; each round is written out.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = written(pairs, "edges")
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        new = written(small, "edges")
        sums = [d.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first() for d in (pairs, new)]
        released(pairs)
        pairs = new
        if tuple(sums[0]) == tuple(sums[1]):
            break
    found = pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    found.written_to = pairs.written_to
    return found
