"""Connected components of a distributed edge list."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import store


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of
    ``edges`` (columns ``u``, ``v``, both long).

    Alternating large-star and small-star rounds (Kiveris et al., "Connected
    components in MapReduce and beyond"): each round is joins and grouped
    minima with map-side combining, so neither a hub nor a long chain meets in
    one task, and a round's edges are written to the shared folder. The loop
    ends when a round changes nothing, which takes about the logarithm of the
    longest path. No edges: no rows.
    """
    now = store(_downward(edges.select(F.col("u").cast("long"), F.col("v").cast("long"))), "edges")
    before = _digest(now)
    while True:
        now = store(_small_star(_large_star(now)), "edges")
        after = _digest(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def _downward(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
        .distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _downward(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").select(F.col("lo").alias("u"), F.col("m").alias("v"))
    return _downward(moved.unionByName(least.select(F.col("hi").alias("u"), F.col("m").alias("v"))))
