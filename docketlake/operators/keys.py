"""Keyed building blocks that stay whole and balanced when one key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def apart(key: str) -> Column:
    """A second grouping column that depends on the key alone.

    Grouping by it too keeps the exchange of a later join on the key directly below
    that join. Adaptive execution splits a skewed side only in that shape; the
    second exchange moves no more than the grouped rows.
    """
    return F.crc32(F.col(key).cast("string")).alias("_apart")


def first_per_key(df: DataFrame, key: str, order: Column, last: bool = False,
                  for_join: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``; for the last, nulls come first.

    An aggregate rather than a ranking window, so copies of a hot key are reduced
    before the shuffle instead of meeting in one task. ``for_join``: the rows are
    going to be joined to a side that may be skewed, see :func:`apart`.
    """
    rest = [c for c in df.columns if c != key]
    pick = F.max_by if last else F.min_by
    return (
        df.groupBy(key, *([apart(key)] if for_join else []))
        .agg(pick(F.struct(*rest), F.struct(order) if last else order).alias("_row"))
        .select(key, "_row.*")
        .select(*df.columns)
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys, ready to be joined to a side that may be skewed."""
    return df.where(F.col(key).isNotNull()).groupBy(key, apart(key)).agg(F.lit(1)).select(key)


def known_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys; broadcast where the type alone bounds their number.

    A DATE has at most 366 values per year, 3.7 million over all years it can hold
    (some 60 MB), so rows with whole texts need no shuffle to be joined by date.
    """
    if dict(df.dtypes)[key] == "date":
        return F.broadcast(df.select(key).where(F.col(key).isNotNull()).distinct())
    return distinct_keys(df, key)


def missing_from(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other`` (left anti join)."""
    return df.join(distinct_keys(other, key), key, "left_anti")


def top_per_group(df: DataFrame, group: str, order: str, n: int, name: str = "rn",
                  salts: int = 32) -> DataFrame:
    """The first ``n`` rows of every group by ``order``, with their rank.

    A first ranking within (group, salt) spreads a hot group over many tasks; what
    it keeps always contains the answer, so the second ranking is exact and sees
    at most ``n * salts`` rows per group.
    """
    ranked = F.row_number()
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    inner = Window.partitionBy(group, "_salt").orderBy(order)
    outer = Window.partitionBy(group).orderBy(order)
    return (
        salted.withColumn("_in", ranked.over(inner)).where(F.col("_in") <= n)
        .withColumn(name, ranked.over(outer)).where(F.col(name) <= n)
        .drop("_salt", "_in")
    )
