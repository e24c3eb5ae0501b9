"""Near-duplicate documents: MinHash bands, signature check, exact check, components.

1. Every text becomes its set of word shingles; equal sets are one class from then on, so
   copies cost nothing more.
2. Universal hash minima per class, in bands; how many follows from the similarity asked for,
   so that two classes of just that similarity miss every band with probability 5e-8 at
   most: at 0.8 they are 32 bands of 4.
3. Classes in a band bucket with others are candidates. A candidate more than a fifth of
   whose shingles no other candidate has can't reach the similarity with any, and leaves.
4. In each bucket, all are compared with the candidate that shares most buckets, which in a
   family of copies is their common origin. Pairs within a bucket that these links leave in
   different components are compared afterwards, once each, where sizes, own shingles and
   the counts of shingles by hash class still allow a link. So no link is lost, and families don't become all their pairs.
5. A compared pair must agree in enough of its minima, and is then confirmed on its sets.
6. Components by large-star and small-star.

Rows with one id are one document, linked if any of its rows is. Null and empty texts and
rows without an id are linked with nothing; a row without an id is kept. Ties don't occur:
the smallest id represents a component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docketlake.llm.common import Staging, per_key, pick
from docketlake.llm.components import components
from docketlake.llm.shingles import mix, shingler

#: Minima up to which bands get more rows, and the chance that a link misses all bands.
MINIMA, MISSED = 128, 5e-8
#: Classes of shingles whose counts bound an intersection.
PROFILE = 256


def bands_for(share: int) -> tuple[int, int]:
    """(bands, rows in a band) for links from ``share`` percent on: most rows that MINIMA allow."""
    if not 1 <= share <= 100:
        raise ValueError(f"share is a percentage from 1 to 100, not {share}")
    found = None
    for rows in range(1, MINIMA + 1):
        hit = (share / 100) ** rows
        bands = 1 if hit == 1 else math.ceil(math.log(MISSED) / math.log1p(-hit))
        if found and bands * rows > MINIMA:
            break
        found = bands, rows
    return found


def least_agreement(share: int, minima: int) -> int:
    """Agreeing minima that a link has: five standard deviations below the expected number pass."""
    s = share / 100
    return max(0, int(minima * (s - 5 * (s * (1 - s) / minima) ** 0.5)))


def signer(minima: int):
    """``hashes -> minima`` of as many universal hash functions, as signed 32-bit numbers."""
    random = np.random.default_rng(20240229)
    a = random.integers(0, 2**64, minima, np.uint64)[:, None] | np.uint64(1)
    b = random.integers(0, 2**64, minima, np.uint64)[:, None]

    def sign(hashes: np.ndarray) -> np.ndarray:
        low = np.full(minima, 2**32 - 1, np.uint64)
        keys = hashes >> np.uint64(32)
        for at in range(0, len(keys), 2048):
            part = (a * keys[None, at: at + 2048] + b) >> np.uint64(32)
            np.minimum(low, part.min(axis=1), out=low)
        return low.astype(np.uint32).view(np.int32)

    return sign


def _lists(rows: list[np.ndarray], kind: pa.DataType, dtype) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows).view(dtype) if rows else np.empty(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _profile(hashes: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of PROFILE classes; more than 32,767 count as that many."""
    counts = np.bincount((hashes & np.uint64(PROFILE - 1)).astype(np.int64), minlength=PROFILE)
    return np.minimum(counts, 32767).astype(np.int16)


def _features(docs: DataFrame, k: int, minima: int, whole_sets: bool) -> DataFrame:
    """(id, n, d1, d2) and the minima; for candidates the sets besides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sign = shingler(k), signer(minima)
        for batch in batches:
            sets = [shingles(t or "") for t in batch["text"].to_pylist()]
            columns = {
                "id": batch["id"],
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "d1": pa.array(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                "d2": pa.array(np.array([mix(s + np.uint64(1)).sum(dtype=np.uint64) for s in sets],
                                        np.uint64).view(np.int64)),
                "minima": _lists([sign(s) for s in sets], pa.int32(), np.int32),
            }
            if whole_sets:
                columns["hashes"] = _lists(sets, pa.int64(), np.int64)
                columns["profile"] = _lists([_profile(s) for s in sets], pa.int16(), np.int16)
            yield pa.RecordBatch.from_pydict(columns)

    schema = "id bigint, n bigint, d1 bigint, d2 bigint, minima array<int>"
    return docs.mapInArrow(run, schema + (", hashes array<bigint>, profile array<smallint>" if whole_sets else ""))


def _alike(share: int) -> Column:
    """Exact: 100 * intersection >= share * union, after the check of the minima."""
    same = F.size(F.filter(F.zip_with("minima_a", "minima_b", lambda x, y: x == y), lambda v: v))
    both = F.size(F.array_intersect("hashes_a", "hashes_b"))
    union = F.size("hashes_a") + F.size("hashes_b") - both
    bands, rows = bands_for(share)
    return (same >= least_agreement(share, bands * rows)) & (100 * both >= share * union)


def _confirmed(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("minima").alias(f"minima_{x}"),
                                 F.col("hashes").alias(f"hashes_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_alike(share)).select("a", "b")


def _may_link(share: int, x: str, y: str) -> Column:
    """Whether sizes and own shingles (``n``, ``own``) of two candidates allow a link."""
    n, own = (lambda s: F.col(f"{s}.n")), (lambda s: F.col(f"{s}.own"))
    most = F.least(n(x) - own(x), n(y) - own(y))
    return 100 * most >= share * (n(x) + n(y) - most)


def _profiles_allow(share: int) -> Column:
    """Whether the intersection can be large enough: per class, no more than the smaller count."""
    most = F.aggregate(F.zip_with("x.profile", "y.profile", lambda p, q: F.least(p, q).cast("bigint")),
                       F.lit(0).cast("bigint"), lambda s, v: s + v)
    full = (F.array_max("x.profile") == 32767) | (F.array_max("y.profile") == 32767)
    return full | (100 * most >= share * (F.col("x.n") + F.col("y.n") - most))


def near_duplicates(docs: DataFrame, k: int = 5, share: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the
    row's own. Links: ``100 * intersection >= share * union`` of the shingle sets.
    """
    spark = docs.sparkSession
    n_bands, n_rows = bands_for(share)
    minima = n_bands * n_rows
    texts = pick(docs, "doc_id", "text").toDF("id", "text")
    with Staging(spark, "near") as staging:
        features = staging.save(_features(texts, k, minima, whole_sets=False))
        classes = staging.save(
            features.where(F.col("id").isNotNull() & (F.col("n") > 0)).groupBy("n", "d1", "d2")
            .agg(F.min("id").alias("id"), F.first("minima").alias("minima"))
        )
        bands = classes.select("id", "n", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(n_bands - 1)),
            lambda b: F.xxhash64(b, F.slice("minima", b * n_rows + 1, F.lit(n_rows)))
        )).alias("band", "bucket"))
        shared = per_key(bands, "bucket", F.count("*").alias("_size")).where("_size > 1").select("bucket")
        members = staging.save(bands.join(shared, "bucket", "left_semi"))
        candidates = members.select("id").distinct()
        sets = staging.save(_features(texts.join(candidates, "id", "left_semi"), k, minima, whole_sets=True))

        # Shingles that one candidate alone has.
        alone = (sets.select("id", F.explode("hashes").alias("h")).groupBy("h")
                 .agg(F.min("id").alias("id"), F.max("id").alias("last")).where("id = last")
                 .groupBy("id").agg(F.count("*").alias("own")))
        able = (sets.groupBy("id").agg(F.max("n").alias("size")).join(alone, "id", "left")
                .select("id", F.coalesce("own", F.lit(0)).alias("own"), "size")
                .where(100 * (F.col("size") - F.col("own")) >= share * F.col("size")).select("id", "own"))
        members = staging.save(members.join(able, "id"))
        links = staging.save(_star_links(members, sets, share))
        parts = components(links, staging)
        rest = staging.save(_remaining_pairs(members, parts, sets, share))
        if not rest.isEmpty():
            more = _confirmed(rest, sets, share)
            links = staging.save(links.unionAll(more))
            parts = components(links, staging)

        of_class = classes.select("n", "d1", "d2", F.col("id").alias("class")).join(
            parts.select(F.col("id").alias("class"), "component"), "class", "left")
        result = features.select("id", "n", "d1", "d2").join(of_class, ["n", "d1", "d2"], "left").select(
            F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "class", "id")).alias("component_id"),
        )
        return staging.keep(result.withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _star_links(members: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Confirmed links of all in a bucket with the one that shares most buckets."""
    sizes = per_key(members, "bucket", F.count("*").alias("size"))
    weight = members.join(sizes, "bucket").groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = members.join(weight, "id")
    centre = per_key(
        weighed, "bucket", F.max(F.struct("weight", (-F.col("id")).alias("neg"), "n", "own")).alias("c")
    ).select("bucket", F.struct((-F.col("c.neg")).alias("id"), "c.n", "c.own").alias("c"))
    pairs = (
        members.select("bucket", F.struct("id", "n", "own").alias("m")).join(centre, "bucket")
        .where((F.col("m.id") != F.col("c.id")) & _may_link(share, "m", "c"))
        .select(F.least("m.id", "c.id").alias("a"), F.greatest("m.id", "c.id").alias("b")).distinct()
    )
    return _confirmed(pairs, sets, share)


def _remaining_pairs(members: DataFrame, parts: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Pairs of a bucket in different components that may still link, each once.

    Left stand only members outside the largest component of their bucket; buckets within
    one component take no part. A pair counts in the first bucket that it shares.
    """
    placed = (members.join(parts, "id", "left")
              .withColumn("component", F.coalesce("component", "id")))
    per = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    largest = (per_key(per, "bucket", F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("parts"))
               .where("parts > 1").select("bucket", F.col("top.component").alias("main")))
    open_ = placed.join(largest, "bucket")
    keys = placed.groupBy("id").agg(F.sort_array(F.collect_set("bucket")).alias("keys"))   # at most one per band
    known = (open_.select("id", "n").distinct().join(keys, "id")
             .join(sets.select("id", "n", "profile"), ["id", "n"]).distinct())
    side = open_.join(known, ["id", "n"]).select(
        "bucket", "main", "component", F.struct("id", "n", "own", "profile").alias("m"), "keys")
    left = side.where("component != main").select("bucket", F.col("component").alias("ca"), F.col("m").alias("x"),
                                                  F.col("keys").alias("kx"))
    right = side.select("bucket", "main", F.col("component").alias("cb"), F.col("m").alias("y"),
                        F.col("keys").alias("ky"))
    return (
        left.join(right, [
            left["bucket"] == right["bucket"],
            F.col("ca") != F.col("cb"),
            (F.col("cb") == F.col("main")) | (F.col("x.id") < F.col("y.id")),
            _may_link(share, "x", "y"),
            F.array_min(F.array_intersect("kx", "ky")) == left["bucket"],
            _profiles_allow(share),
        ])
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    )
