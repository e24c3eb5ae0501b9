"""Conversations as a trie of their prefixes, with totals of every subtree.

A turn is known by 128 bits of hash over role and text. Each turn of a conversation gives a
number that depends on its place too; the exclusive or of those up to depth d names the
prefix. So a name is a running aggregate, a parent's name is the node's without the last
number, and no conversation need be in one task: turns are dealt in order over ranges, a
long conversation lies in several (its blocks), and what stands in earlier blocks comes from
one row per block. Totals of subtrees are those of :mod:`contraction`.

Turns are ordered by ``turn``, null first, then by their hashes; null roles and texts count as
empty. Repeated rows are repeated turns. Rows without a ``conv_id`` belong to no conversation.
A conversation without turns is a member of the root only; without conversations there is no
root. Columns besides the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docketlake.llm.common import Staging, pick, whole
from docketlake.llm.contraction import subtree_totals

WORD = r"[^\x20\x09-\x0D]+"
ROOT = -1
#: Ids that follow each other within 2**CHUNK are written out together before they are hashed.
CHUNK = 12
NAME = ["depth", "n1", "n2"]


def _none() -> Column:
    return F.lit(0).cast("bigint")


def ordered_turns(conversations: DataFrame, staging: Staging) -> DataFrame:
    """(conv_id, block, pos from 1, t1, t2, words) for every turn."""
    role, text = whole("role"), whole("text")
    turns = pick(conversations, "conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
    order = [F.col("turn").asc_nulls_first(), "t1", "t2"]
    dealt = staging.save(turns.repartitionByRange("conv_id", *order).withColumn("block", F.spark_partition_id()))
    block = ["conv_id", "block"]
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy(*block).agg(F.count("*").alias("n")).select(
        *block, F.coalesce(F.sum("n").over(before), _none()).alias("before"))
    return staging.save(
        dealt.withColumn("rank", F.row_number().over(Window.partitionBy(*block).orderBy(*order)))
        .join(begins, block).select(*block, (F.col("before") + F.col("rank")).alias("pos"), "t1", "t2", "words"))


def with_family_start(turns: DataFrame, family: int, most: int, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(turns rebuilt, conversations): the first h turns are those of the family's first id.

    h = crc32(decimal conv_id) mod ``most``; the family of c begins at c - c % ``family``
    (the remainder has the sign of c). Its turns form a block before all others.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most))
    base = F.col("conv_id") - F.col("conv_id") % family
    blocks = staging.save(turns.groupBy("conv_id", "block").agg(F.sum((F.col("pos") > h).cast("bigint")).alias("own")))
    heads = (turns.where((F.col("conv_id") == base) & (F.col("pos") < most)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "t1", "t2", "words"))).alias("head")))   # below ``most``
    nothing = F.array().cast("array<struct<pos:bigint,t1:bigint,t2:bigint,words:bigint>>")
    head = F.when(F.col("head").isNull(), nothing).otherwise(F.slice("head", F.lit(1), h.cast("int")))
    starts = staging.save(
        blocks.groupBy("conv_id").agg(F.sum("own").alias("own")).withColumn("base", base).join(heads, "base", "left")
        .select("conv_id", "own", head.alias("head"))
        .select("conv_id", "head", "own", F.size("head").cast("bigint").alias("lead"))
        .withColumn("length", F.col("lead") + F.col("own")))
    leads = blocks.join(starts.select("conv_id", "lead"), "conv_id").select("conv_id", "block", "lead")
    own = (turns.where(F.col("pos") > h).join(leads, ["conv_id", "block"])
           .select("conv_id", "block", (F.col("pos") - h + F.col("lead")).alias("pos"), "t1", "t2", "words"))
    first = (starts.select("conv_id", F.lit(-1).alias("block"), F.explode("head").alias("t"))
             .select("conv_id", "block", "t.pos", "t.t1", "t.t2", "t.words"))
    return staging.save(own.unionByName(first)), starts.select("conv_id", "length")


def _prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per turn the name of the prefix that it ends, of that before it, and whether all ends there."""
    block = ["conv_id", "block"]
    numbered = turns.withColumns({f"x{i}": F.xxhash64(F.lit(i), "pos", "t1", "t2") for i in (1, 2)})
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        numbered.groupBy(*block).agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"))
        .select(*block, *(F.coalesce(F.bit_xor(b).over(before), _none()).alias(b) for b in ("b1", "b2")))
        .join(conversations, "conv_id"))
    so_far = Window.partitionBy(*block).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    names = {f"n{i}": F.bit_xor(f"x{i}").over(so_far).bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)}
    return numbered.join(begins, block).withColumns(names).select(
        "conv_id", F.col("pos").alias("depth"), "n1", "n2", F.col("n1").bitwiseXOR(F.col("x1")).alias("p1"),
        F.col("n2").bitwiseXOR(F.col("x2")).alias("p2"), "words", (F.col("pos") == F.col("length")).alias("ends"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per name from its rows, which follow each other in the order of their ids."""
    name, digest = None, None
    for batch in batches:
        out = []
        columns = [batch[c].to_pylist() for c in (*NAME, "ids")]
        for *key, ids in zip(*columns):
            if key != name:
                if name is not None:
                    out.append((*name, digest.hexdigest()))
                name, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _digest_batch(out)
    if name is not None:
        yield _digest_batch([(*name, digest.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*NAME, "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(name, SHA-256 of the ids ascending, joined by commas), of any number of ids in constant memory."""
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))   # 2**CHUNK at most
    chunks = ends.groupBy(*NAME, F.shiftright("conv_id", CHUNK).alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))
    return chunks.repartition(*NAME).sortWithinPartitions(*NAME, "chunk").mapInArrow(
        _digests, "depth bigint, n1 bigint, n2 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame, staging: Staging) -> DataFrame:
    """One row per node; ``turns`` as of :func:`ordered_turns`, ``conversations`` (conv_id, length).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (words that members share with the first of them, over the subtree),
    ends_sha256 (of the members that end here).
    """
    prefixes = staging.save(_prefixes(turns, conversations))
    nodes = prefixes.groupBy(*NAME).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("words").alias("words"),
        F.first("p1").alias("p1"), F.first("p2").alias("p2")).withColumn("id", F.monotonically_increasing_id())
    zero = {c: _none() for c in (*NAME, "words", "p1", "p2")}
    root = (conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
            .withColumns({**zero, "id": F.lit(ROOT).cast("bigint")}))
    nodes = staging.save(nodes.unionByName(root))
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"),
                      F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # All first turns have one parent, which needs no join.
    top = root.select(F.col("conv_id").alias("parent_conv_id"), F.lit(ROOT).cast("bigint").alias("parent"))
    first = nodes.where("depth = 1").join(F.broadcast(top))   # one row
    deeper = nodes.where("depth > 1").join(up.where("depth > 1"), ["depth", "p1", "p2"])
    none = {"parent": F.lit(None).cast("bigint"), "parent_conv_id": F.lit(None).cast("bigint")}
    linked = staging.save(deeper.unionByName(first).unionByName(nodes.where("depth = 0").withColumns(none)))
    children = (linked.where("depth > 0").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children")))
    linked = staging.save(
        linked.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", _none())))
    tree = linked.select("id", "parent", "depth", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
                         ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"], staging)
    turnless = conversations.where("length = 0").select(*(_none().alias(c) for c in NAME), "conv_id")
    ends = _end_digests(prefixes.where("ends").select(*NAME, "conv_id").unionByName(turnless))
    return staging.keep(
        linked.join(totals, "id").join(ends, NAME, "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
