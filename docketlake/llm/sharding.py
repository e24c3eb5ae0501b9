"""Sharding by balanced label propagation, over columns only.

Documents with equal texts are linked. A document's label is its shard; at first a hash of
its id. In every round a group of linked documents looks where most of its members are, and
those elsewhere ask to move there. Requests are granted in order, large groups first, while
the target shard has room under its quota; a group too large for one shard fills one and
goes on in the next that has most of it. Documents without links have no wish and take what
room is left, moving only where a shard holds too many. So shards end with counts at most
one apart (law ``rows``), and cut links only where a quota forces it.

Members of a group are alike, so rounds work on (group, shard, count) cells, of which a
group of any size has at most as many as there are shards. Positions within a shard or
group are counted in salted parts whose offsets come from their totals; no window spans a
whole shard or group.

A null text counts as empty. Rows that repeat an id, or have none, are placed one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docketlake.llm.common import Staging, per_key, pick, whole

SHARDS = 40
ROUNDS = 6
#: Rows of a shard or group that are put in order together, about.
ROWS_TOGETHER = 500_000


def _constant(numbers: list[int]) -> Column:
    return F.array(*(F.lit(x).cast("bigint") for x in numbers))


def _position(df: DataFrame, keys: list[str], order: list[str], name: str, parts: int,
              first: Column | None = None) -> DataFrame:
    """Gapless positions from 0 within ``keys``; rows where ``first`` holds come first.

    Beyond that any order will do, so rows are dealt to parts by a hash and sorted within
    parts only; the totals of the parts give where each begins.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int")
    if first is not None:
        part = part + F.when(first, 0).otherwise(parts)
    salted = df.withColumn("_part", part)
    totals = salted.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    return (ranked.join(offsets, [*keys, "_part"])
            .withColumn(name, F.col("_before") + F.col("_rank") - 1).drop("_part", "_before", "_rank"))


def _granted(requests: DataFrame, parts: int) -> DataFrame:
    """``moved`` of each request (group, source, target, n, size, free): larger groups first.

    Sizes fall in powers of two, and each class in parts by a hash, so no task ranks all.
    """
    part = (64 - F.floor(F.log2("size"))) * parts + F.pmod(F.xxhash64("group"), F.lit(parts))
    salted = requests.withColumn("_part", part)
    totals = salted.groupBy("target", "_part").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy("target").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("target", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = (Window.partitionBy("target", "_part").orderBy(F.col("size").desc(), "group", "source")
              .rowsBetween(Window.unboundedPreceding, -1))
    asked = (salted.withColumn("_within", F.coalesce(F.sum("n").over(within), F.lit(0)))
             .join(offsets, ["target", "_part"]))
    left = F.greatest(F.col("free") - F.col("_before") - F.col("_within"), F.lit(0))
    return asked.select("group", "source", "target", F.least(left, F.col("n")).alias("moved")).where("moved > 0")


def _round(cells: DataFrame, quotas: list[int], parts: int, number: int) -> DataFrame:
    """One round of moves between the cells (group, shard, n) of linked documents."""
    used = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}   # one per shard
    room = [max(0, q - used.get(s, 0)) for s, q in enumerate(quotas)]
    rooms, roomy = _constant(room), [s for s, r in enumerate(room) if r] or [0]
    cells = cells.select("group", "shard", "n")
    # A scattered group that can gather in none of its shards may try one with room.
    stuck = (cells.groupBy("group").agg(F.sum("n").alias("size"), F.count("*").alias("cells"),
                                        F.max(F.col("n") + F.get(rooms, F.col("shard"))).alias("most"))
             .where("cells > 1 AND most < size"))
    tried = stuck.select("group", F.get(_constant(roomy), F.pmod(F.xxhash64("group", F.lit(number)), F.lit(len(roomy)))
                                        .cast("int")).cast("int").alias("shard"), F.lit(0).cast("bigint").alias("n"))
    all_cells = cells.unionByName(tried).groupBy("group", "shard").agg(F.sum("n").alias("n")).withColumn(
        "free", F.get(rooms, F.col("shard")))
    # A group's shards, best first: where it can have most members, then where it has them now.
    of_group = Window.partitionBy("group")
    ranked = (
        all_cells.withColumn("size", F.sum("n").over(of_group))
        .withColumn("place", F.row_number().over(of_group.orderBy(
            F.least(F.col("n") + F.col("free"), "size").desc(), F.col("n").desc(), F.xxhash64("group", "shard"))) - 1)
        .withColumn("homes", F.ceil(F.col("size") / max(1, min(quotas))).cast("int"))
    )
    homes = ranked.where("place < homes AND free > 0").select(
        "group", F.col("place").alias("wish"), F.col("shard").alias("target"), "free")
    requests = (
        ranked.where("place >= homes AND n > 0").drop("free")
        .withColumn("wish", F.pmod("place", "homes")).join(homes, ["group", "wish"])
        .select("group", F.col("shard").alias("source"), "target", "n", "size", "free"))
    moves = _granted(requests, parts)
    changes = moves.select("group", F.col("source").alias("shard"), (-F.col("moved")).alias("n")).unionByName(
        moves.select("group", F.col("target").alias("shard"), F.col("moved").alias("n")))
    return (cells.unionByName(changes).groupBy("group", "shard")
            .agg(F.sum("n").alias("n")).where("n > 0"))


def _members_placed(linked: DataFrame, cells: DataFrame, parts: int) -> DataFrame:
    """Each linked row with the shard of the cell that its position in the group falls into."""
    before = Window.partitionBy("group").orderBy("shard")
    ends = (cells.withColumn("end", F.sum("n").over(before)).groupBy("group")
            .agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("cells")))   # one per shard at most
    placed = _position(linked, ["group"], ["doc_id", "text_crc32"], "_member", parts).join(ends, "group")
    at = F.size(F.filter("cells", lambda c: c["end"] <= F.col("_member")))
    return placed.withColumn("shard", F.get("cells", at)["shard"]).drop("cells", "_member")


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    ``slot`` is the row's position in its shard, gapless from 0. ``grown_shard`` is null:
    the law ``rows`` says nothing about a shard more.
    """
    texts = pick(docs, "doc_id", "text").select("doc_id", whole("text").alias("text"))
    rows = texts.select(
        "doc_id", (F.octet_length("text") + 16).cast("bigint").alias("size"),
        F.crc32("text").alias("text_crc32"), F.xxhash64("text", F.octet_length("text")).alias("group"))
    by_hash = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    with Staging(docs.sparkSession, "shards") as staging:
        rows = staging.save(rows)
        total = rows.count()
        parts = max(16, -(-total // ROWS_TOGETHER))
        quotas = [total // shards + (s < total % shards) for s in range(shards)]
        groups = per_key(rows, "group", F.count("*").alias("_n")).where("_n > 1").select("group")
        linked = staging.save(rows.join(groups, "group", "left_semi"))
        cells = staging.save(linked.groupBy("group", by_hash.alias("shard")).agg(F.count("*").alias("n")))
        for number in range(rounds):
            cells = staging.save(_round(cells, quotas, parts, number))
        placed = _members_placed(linked, cells, parts)
        alone = rows.join(groups, "group", "left_anti").withColumn("shard", by_hash)
        columns = ["doc_id", "size", "text_crc32", "shard"]
        wished = staging.save(placed.select(*columns, F.lit(True).alias("linked")).unionByName(
            alone.select(*columns, F.lit(False).alias("linked"))))
        order = ["doc_id", "text_crc32", "size"]
        ranked = staging.save(_position(wished, ["shard"], order, "slot", parts, first=F.col("linked")))

        # What exceeds a shard's quota fills the gaps of the others, in the order of the shards.
        has = {r["shard"]: r["n"] for r in ranked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        kept = [min(has.get(s, 0), q) for s, q in enumerate(quotas)]
        ends, gaps = [], 0
        for k, q in zip(kept, quotas):
            gaps += q - k
            ends.append(gaps)
        real = _constant(quotas)
        over = _position(ranked.where(F.col("slot") >= F.get(real, F.col("shard"))).withColumn("_all", F.lit(0)),
                         ["_all"], order, "_at", parts)
        to = F.size(F.filter(_constant(ends), lambda e: e <= F.col("_at")))
        begin = _constant([e - (q - k) for e, q, k in zip(ends, quotas, kept)])
        moved = over.withColumn("shard", to).withColumn(
            "slot", F.get(_constant(kept), F.col("shard")) + F.col("_at") - F.get(begin, F.col("shard")))
        stays = ranked.where(F.col("slot") < F.get(real, F.col("shard")))
        names = ["doc_id", "size", "text_crc32", "shard", "slot"]
        return staging.keep(stays.select(*names).unionByName(moved.select(*names)).select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard")))
