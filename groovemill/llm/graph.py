"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges(u, v): component is the smallest node that links reach.

    Each round points every node's larger neighbours, then its smaller ones, at the smallest node it knows, until
    nothing changes: a number of rounds about the logarithm of the longest chain. Minimums are partial sums, so a node
    with very many links isn't gathered in one place, and each round is written to the shared folder.
    """
    known = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(known)
    for _ in range(MAX_ROUNDS):
        both = known.unionByName(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        small = small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        known = staged(small, "edges")
        before, state = state, _state(known)
        if state == before:
            break
    else:
        raise RuntimeError("components didn't settle")
    return known.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(known.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())
