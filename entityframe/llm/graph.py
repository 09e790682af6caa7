"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.llm.store import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b); the component is its smallest node.

    Every round links each node's neighbours to the smallest of them, first
    those above the node, then those below, until nothing changes: a number of
    rounds that grows with the logarithm of the longest path. Each round is
    written to the shared folder. Edges of a hub are joined on the hub, which
    Spark splits; nothing is gathered per node but a minimum.
    """
    pairs = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(low, "hi")
            .select(F.explode(F.array(F.struct("hi", "m"), F.struct(F.col("lo").alias("hi"), "m"))).alias("e"))
            .select(F.col("e.hi").alias("hi"), F.col("e.m").alias("lo"))
            .where("hi <> lo")
            .distinct()
        )
        pairs = stage(small, "star")
        now = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")), F.countDistinct("hi")
        ).first()
        # Done once a round changed nothing and every node has one parent.
        if tuple(now) == before and now[0] == now[2]:
            break
        before = tuple(now)
    roots = pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
