"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import stored


def _minima(edges: DataFrame) -> DataFrame:
    return stored(edges.groupBy("u").agg(F.min("v").alias("least")), "minima")


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of the edges (a, b).

    Alternating large-star and small-star steps: each node's neighbours are hung on its least neighbour, until every
    edge leads straight to the least node. The number of rounds is logarithmic; edges are written after each step, and
    no node's neighbours meet in one task: minima are partial sums and the joins can be split.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        mark = _checksum(now)
        if mark == before:
            break
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined = both.join(_minima(both), "u").where(F.col("v") > F.col("u"))
        large = stored(joined.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct(), "edges")
        joined = large.join(_minima(large), "u")
        small = joined.where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        now = stored(small.unionByName(joined.select("u", F.col("least").alias("v"))).distinct(), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
