"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

MAX_ROUNDS = 60  # rounds needed grow with the logarithm of the longest chain


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): for every node of ``links`` (a, b: long) the smallest node reachable.

    Every round is a map-side combined minimum per node and a join on the node, so a hub
    is one row per map task in the first and split by the skew join in the second; rounds
    are stored in the shared folder, so a lost executor costs one round at most."""
    edges = _oriented(links.filter("a <> b"))
    edges = stored(edges.distinct(), "components")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b"))
        edges = stored(small.distinct(), "components")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == state:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
    return edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.col("m").alias("component")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _oriented(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
