"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftgraph.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """The least node reachable from each node of ``links`` (columns a, b): node, component.

    Each round hangs every node's neighbours below the least of them, first the
    larger neighbours, then the smaller; rounds end when every node hangs directly
    below the least of its component. Each round is a written table. Neighbour
    lists are never gathered: the least one is an aggregate, joined back.
    """
    edges = scratch.keep(
        links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .where(F.col("high") > F.col("low"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        both = both.select(F.col("high").alias("node"), F.col("low").alias("other"))
        least = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))
        large = both.where(F.col("other") > F.col("node")).join(least, "node").select("other", "least")
        large = large.select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        large = scratch.keep(large, "edges")
        low = large.groupBy("node").agg(F.min("other").alias("least"))
        small = large.join(low, "node")
        edges = (
            small.select(F.col("other").alias("high"), F.col("least").alias("low"))
            .where(F.col("high") > F.col("low"))
            .unionByName(low.select(F.col("node").alias("high"), F.col("least").alias("low")))
            .distinct()
        )
        edges = scratch.keep(edges, "edges")
        state = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low")), F.bit_xor(F.xxhash64("low", "high", "high"))
        ).first()
        if state == before:
            roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)
        before = state
