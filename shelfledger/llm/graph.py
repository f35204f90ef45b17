"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfledger.llm.common import Stage


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """``node`` and ``root``, the smallest node that it is joined to, for every node of ``a``-``b`` edges.

    Alternates the two star steps: first every node ties its larger neighbours to the smallest one around, then its smaller
    ones; edges only ever shrink to stars. Each round's edges are written. A node with very many neighbours has
    its least one found by a summed grouping and meets its neighbours in a join that adaptive execution splits.
    Null ends and loops give nothing.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stage(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b <> least")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b"))
        tied = least.select("a", F.col("least").alias("b"))
        edges = stage(small.where("a > b").union(tied).distinct())
        before, state = state, edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
