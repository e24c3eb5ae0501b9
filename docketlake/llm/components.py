"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docketlake.llm.common import Staging, per_key


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = per_key(both, "u", F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = per_key(edges, "u", F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(id, component): the smallest id that each linked id can reach.

    ``edges`` has two columns of ids. A hub's neighbours are never gathered: its minimum is
    an aggregate, joined back in a join that adaptive execution can split. Every half round
    is written to the shared folder.
    """
    a, b = edges.columns
    now = staging.save(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col("u") != F.col("v")).distinct()
    )
    state = None
    while True:
        new = _mark(now)
        if new == state:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = new
        large = staging.save(_large_star(now).where(F.col("u") != F.col("v")).distinct())
        now = staging.save(_small_star(large).where(F.col("u") != F.col("v")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number and digest of the edges: unchanged means that the stars are final."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.bitwiseAND(0xFFFFFFFF))).first())
