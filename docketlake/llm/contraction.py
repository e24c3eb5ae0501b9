"""Subtree totals by parallel tree contraction.

Rounds alternate two steps until only roots are left. Rake: every leaf has its total; it goes
into its parent. Compress: of the nodes with one child that is left, an independent set is
spliced out; the child hangs from the parent's parent, and what the chain lost stands on its
edge. Of two such neighbours the one at the odder depth goes (depths that the higher power of
two divides stay), so a chain halves in a round and a path of n nodes takes about log2(n).
Then the rounds are undone from the last: a spliced node's total is that of the child it had
plus what was recorded, and that child was contracted in a later round.

The tables of the rounds shrink geometrically. Every step is an aggregate or a join on node
ids, written to the shared folder; a node with very many children is an aggregate or the
larger side of a join of plain tables, which adaptive execution can split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from docketlake.llm.common import Staging


def _raked(now: DataFrame, values: list[str], staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(leaves with their totals, all other nodes with the leaves' totals added)."""
    kids = (now.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id"))
            .agg(F.count("*").alias("kids")))
    state = staging.save(now.join(kids, "id", "left"))
    leaves = state.where(F.col("kids").isNull())
    gained = (leaves.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id"))
              .agg(F.count("*").alias("gone"), *(F.sum(F.col(v) + F.col(f"{v}_edge")).alias(f"{v}_more") for v in values)))
    none = F.lit(0).cast("bigint")
    rest = staging.save(
        state.where(F.col("kids").isNotNull()).join(gained, "id", "left")
        .withColumns({v: F.col(v) + F.coalesce(f"{v}_more", none) for v in values})
        .withColumn("kids", F.col("kids") - F.coalesce("gone", none))
        .drop("gone", *(f"{v}_more" for v in values)))
    return leaves.select("id", *values), rest


def _spliced(rest: DataFrame, values: list[str], staging: Staging) -> DataFrame:
    """Nodes to splice: node, its parent, its child, ``*_off`` from the child's total to its own."""
    unary = (F.col("kids") == 1) & F.col("parent").isNotNull()
    turn = F.struct(F.col("depth").bitwiseAND(-F.col("depth")), F.xxhash64("id"), "id")
    nodes = rest.withColumns({"unary": unary, "turn": turn})
    child = nodes.select(F.col("id").alias("child"), F.col("parent").alias("node"), F.col("unary").alias("both"),
                         F.col("turn").alias("child_turn"), *(F.col(f"{v}_edge").alias(f"{v}_child") for v in values))
    pairs = staging.save(
        nodes.where("unary").select(F.col("id").alias("node"), "parent", "turn", *values, *(f"{v}_edge" for v in values))
        .join(child, "node")
        .select("node", "parent", "child", "both", "turn", "child_turn",
                *((F.col(v) + F.col(f"{v}_child")).alias(f"{v}_off") for v in values),
                *((F.col(v) + F.col(f"{v}_child") + F.col(f"{v}_edge")).alias(f"{v}_edge") for v in values)))
    stays = pairs.where("both").select(
        F.when(F.col("turn") < F.col("child_turn"), F.col("child")).otherwise(F.col("node")).alias("node")).distinct()
    return staging.save(pairs.join(stays, "node", "left_anti").drop("both", "turn", "child_turn"))


def _without_spliced(rest: DataFrame, spliced: DataFrame, values: list[str]) -> DataFrame:
    edges = [f"{v}_edge" for v in values]
    changes = spliced.select(F.col("child").alias("id"), F.col("parent").alias("to"), F.lit(False).alias("gone"),
                             *(F.col(e).alias(f"{e}_new") for e in edges)).unionByName(
        spliced.select(F.col("node").alias("id"), F.lit(None).cast("bigint").alias("to"), F.lit(True).alias("gone"),
                       *(F.lit(None).cast("bigint").alias(f"{e}_new") for e in edges)))
    return (rest.drop("kids").join(changes, "id", "left").where(~F.coalesce("gone", F.lit(False)))
            .select("id", F.coalesce("to", "parent").alias("parent"), "depth", *values,
                    *(F.coalesce(f"{e}_new", e).alias(e) for e in edges)))


def subtree_totals(tree: DataFrame, values: list[str], staging: Staging) -> DataFrame:
    """(id, *values): the sum of each bigint value over every node's subtree, itself included.

    ``tree`` has the bigint columns id, parent (null at a root), depth (a root's is 0) and
    the values. Several roots make a forest; an empty tree has no totals.
    """
    now = staging.save(tree.select("id", "parent", "depth", *values,
                                   *(F.lit(0).cast("bigint").alias(f"{v}_edge") for v in values)))
    rounds = []
    while True:
        leaves, rest = _raked(now, values, staging)
        if not rest.head(1):
            rounds.append((leaves, None))
            break
        spliced = _spliced(rest, values, staging)
        rounds.append((leaves, spliced))
        now = staging.save(_without_spliced(rest, spliced, values))
    known: list[DataFrame] = []
    for leaves, spliced in reversed(rounds):
        if spliced is not None and spliced.head(1):
            later = reduce(DataFrame.unionByName, known)
            known.append(staging.save(
                spliced.join(later.withColumnRenamed("id", "child"), "child")
                .select(F.col("node").alias("id"), *((F.col(v) + F.col(f"{v}_off")).alias(v) for v in values))))
        known.append(leaves)
    return reduce(DataFrame.unionByName, known)
