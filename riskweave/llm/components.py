"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweave.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of `edges` (a, b): label is the smallest node that can be reached.

    Each step hangs the larger neighbours of a node, then the smaller ones, on its smallest neighbour,
    until nothing changes; the number of steps grows with the logarithm of the longest chain. Steps
    are aggregations and joins, written to the shared folder; only a count and a checksum reach the driver.
    A node with very many neighbours is split by adaptive execution.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, before = stored(pairs, "links"), None
    while (now := _checksum(pairs)) != before:
        before = now
        pairs = stored(_small(_large(pairs)), "links")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots).groupBy("node").agg(F.min("label").alias("label"))


def _checksum(pairs: DataFrame) -> tuple:
    # Halves of the hash, as a sum of whole hashes could overflow.
    h = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count("*"), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(0xFFFFFFFF))).first())


def _large(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    hung = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return hung.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    ).distinct()
