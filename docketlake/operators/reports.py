"""Report aggregates over the six tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docketlake.functions.labels import percent_label, spaced_label, title_label
from docketlake.operators.manifest import ON_DISK


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def with_status(df: DataFrame, column: str, *statuses: str) -> DataFrame:
    return df.where(F.col(column).isin(*statuses))


def digests_parsed(parsing: DataFrame) -> DataFrame:
    return total(with_status(parsing, "parsing_status", *ON_DISK))


def parse_failures(parsing: DataFrame) -> DataFrame:
    return total(with_status(parsing, "parsing_status", "failed"))


def files_on_disk(manifest: DataFrame) -> DataFrame:
    return total(with_status(manifest, "download_status", *ON_DISK))


def years_in_manifest(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.countDistinct("year").alias("n"))


def unique_respondents(respondents: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct names as they are written; exact unless asked otherwise."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return respondents.agg(count("name").alias("n"))


def settlement_rate(actions: DataFrame) -> DataFrame:
    """Settled actions among those that say whether they were settled.

    The label is ``—`` when none says so; an empty table has no numbers at all.
    """
    def rows(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    sums = actions.agg(rows(F.col("settlement")).alias("settled"),
                       rows(F.col("settlement").isNotNull()).alias("total"))
    rate = F.try_divide(F.col("settled"), F.col("total"))
    return sums.withColumn("rate", rate).withColumn(
        "label", F.when(F.col("total").isNotNull(), percent_label(rate)))


def actions_by_month(actions: DataFrame) -> DataFrame:
    """Actions by month; a month without any is absent."""
    month = F.date_trunc("month", "digest_date").cast("date")
    return actions.groupBy(month.alias("month")).agg(F.count("*").alias("n"))


def _counts(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def _with_share(counts: DataFrame) -> DataFrame:
    """Share of the grand total, as a scalar subquery: no window over all groups."""
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def action_types(actions: DataFrame) -> DataFrame:
    counts = _counts(actions, F.col("action_type").alias("type"))
    return _with_share(counts).withColumn("label", title_label(F.col("type")))


def entity_types(respondents: DataFrame) -> DataFrame:
    """Respondents by type; a missing type counts as ``unknown``."""
    kind = F.coalesce("entity_type", F.lit("unknown"))
    counts = _counts(respondents, kind.alias("type"))
    return _with_share(counts).withColumn("label", title_label(F.col("type"))).orderBy(
        F.desc("n"), "type")


def sanction_types(sanctions: DataFrame) -> DataFrame:
    """Sanctions by type with the rank of their count (1 for the smallest).

    The dense rank is taken over the distinct counts. Distinct counts that add up
    to N rows number at most sqrt(2N), so that window stays small however many
    types there are.
    """
    counts = _counts(sanctions.where(F.col("sanction_type").isNotNull()), "sanction_type")
    ranks = counts.select("n").distinct().withColumn(
        "rank", F.row_number().over(Window.orderBy("n")))
    return (
        counts.join(ranks, "n")
        .select("sanction_type", spaced_label(F.col("sanction_type")).alias("label"), "n", "rank")
        .orderBy(F.desc("n"), "sanction_type")
    )


def top_respondents(respondents: DataFrame, k: int = 100) -> DataFrame:
    """The most frequent pairs of name and type; ties go by name, then type."""
    return (
        _counts(respondents, "name", "entity_type")
        .orderBy(F.desc("n"), F.asc_nulls_first("name"), F.asc_nulls_first("entity_type")).limit(k)
        .select("name", title_label(F.coalesce("entity_type", F.lit("unknown"))).alias("type"),
                F.col("n").alias("actions"))
    )


def top_statutes(violations: DataFrame, k: int = 20) -> DataFrame:
    return (
        _counts(violations.where(F.col("statute").isNotNull()), "statute")
        .orderBy(F.desc("n"), "statute").limit(k)
    )


def settlement_by_type(actions: DataFrame, include_zero: bool = False) -> DataFrame:
    """Settled actions and their share by type; a type with none settled is left out."""
    rates = actions.where(F.col("settlement").isNotNull()).groupBy("action_type").agg(
        F.count_if("settlement").alias("n"), F.count("*").alias("total"))
    if not include_zero:
        rates = rates.where("n > 0")
    return rates.select("action_type", "n", (F.col("n") / F.col("total")).alias("pct"),
                        title_label(F.col("action_type")).alias("label"))


def coverage_by_year(manifest: DataFrame) -> DataFrame:
    """Files on disk among the days tried, by year, in one pass."""
    s = F.col("download_status")
    counts = manifest.groupBy("year").agg(
        F.count_if(s.isin(ON_DISK)).alias("on_disk"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(s == "pending").alias("pending"),
    )
    tried = F.col("on_disk") + F.col("failed")
    return counts.withColumn("attempted", tried).withColumn(
        "coverage_pct", F.try_divide(F.col("on_disk"), F.col("attempted")))


def parse_quality(parsing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Share of every status among a year's parse results, for completed and skipped.

    Both sides are counted by path before the join, so a path that holds a large
    part of either table is one row there, and the counts multiply.
    """
    parses = parsing.groupBy("pdf_path").agg(
        F.count_if(F.col("parsing_status") == "completed").alias("completed"),
        F.count_if(F.col("parsing_status") == "skipped").alias("skipped"),
        F.count("*").alias("all"),
    )
    files = manifest.where(F.col("year").isNotNull()).groupBy("local_path", "year").agg(
        F.count("*").alias("copies"))
    joined = parses.join(files, F.col("pdf_path") == F.col("local_path"))
    per_year = joined.groupBy("year").agg(
        *[F.sum(F.col(c) * F.col("copies")).alias(c) for c in ("completed", "skipped", "all")])
    rows = per_year.select("year", F.col("all").alias("total"), F.explode(F.create_map(
        F.lit("completed"), F.col("completed"), F.lit("skipped"), F.col("skipped"),
    )).alias("parsing_status", "n"))
    return rows.where("n > 0").select(
        "year", "parsing_status", "n", "total", (F.col("n") / F.col("total")).alias("pct")
    ).orderBy("year", "parsing_status")
