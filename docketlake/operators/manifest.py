"""The download manifest: what to fetch, and what became of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docketlake.functions import urls
from docketlake.operators.keys import first_per_key, missing_from
from docketlake.schemas import FIRST_YEAR, LAST_YEAR

# Fixed values.
NOT_FOUND = "404 Not Found (likely weekend/holiday)"
ON_DISK = ["completed", "skipped"]


def calendar(years: DataFrame) -> DataFrame:
    """Every calendar day of the years in column ``year``, weekends included."""
    start, end = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    return years.select("year", F.explode(F.sequence(start, end)).alias("date")).withColumn(
        "is_weekday", F.weekday("date") < 5
    )


def build_manifest(days: DataFrame, base: str, output: str = urls.DEFAULT_OUTPUT) -> DataFrame:
    """Pending manifest rows for the days in column ``date``."""
    day = F.col("date")
    return days.select(
        urls.digest_url(day, base).alias("url"),
        F.year(day).alias("year"),
        day,
        urls.local_path(day, output).alias("local_path"),
        F.lit("pending").alias("download_status"),
        F.lit(None).cast("bigint").alias("file_size_bytes"),
        F.lit(None).cast("timestamp_ntz").alias("downloaded_at"),
        F.lit(None).cast("string").alias("error_message"),
    )


def candidates(days: DataFrame, base: str) -> DataFrame:
    """One row per day and address to try, ranked from 1."""
    ranked = F.posexplode(urls.candidate_urls(F.col("date"), base))
    return days.select("*", ranked.alias("_pos", "candidate_url")).select(
        *days.columns, (F.col("_pos") + 1).alias("cand_rank"), "candidate_url"
    )


def in_years(df: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR,
             column: str = "year") -> DataFrame:
    """Rows of a range of years; the range must lie within the archive's span."""
    if not FIRST_YEAR <= first <= last <= LAST_YEAR:
        raise ValueError(f"years must lie in {FIRST_YEAR}..{LAST_YEAR}, got {first}..{last}")
    return df.where(F.col(column).between(first, last))


def insert_missing(target: DataFrame, batch: DataFrame, order: Column) -> DataFrame:
    """``target`` plus the rows of ``batch`` whose url is new; the first copy wins."""
    new = first_per_key(batch, "url", order)
    known = target.select("url").distinct()
    fresh = new.join(known, "url", "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def without_failed(batch: DataFrame, manifest: DataFrame, retry_non_404: bool = False) -> DataFrame:
    """Leave out urls that the manifest already records as failed.

    ``retry_non_404`` keeps those that failed for another reason than a 404.
    """
    failed = manifest.where(F.col("download_status") == "failed")
    if retry_non_404:
        failed = failed.where(F.col("error_message") == NOT_FOUND)
    return missing_from(batch, failed.select("url"), "url")


def update_manifest(target: DataFrame, results: DataFrame, order: Column) -> DataFrame:
    """Write results into the manifest by url; unknown urls change nothing.

    Of several results of a url the last by ``order`` wins.

    A ``skipped`` result keeps the time and message of the earlier download.
    ``results``: url, download_status, file_size_bytes, downloaded_at, error_message.
    """
    state = ["download_status", "file_size_bytes", "downloaded_at", "error_message"]
    latest = first_per_key(results.select("url", *state), "url", order, last=True, for_join=True)
    new = latest.select("url", F.struct(*state).alias("_new"))
    hit, skipped = F.col("_new").isNotNull(), F.col("_new.download_status") == "skipped"

    def value(name: str) -> Column:
        changed = F.col(f"_new.{name}")
        if name in ("downloaded_at", "error_message"):
            changed = F.when(skipped, F.coalesce(changed, F.col(name))).otherwise(changed)
        return F.when(hit, changed).otherwise(F.col(name)).alias(name)

    keep = [value(c) if c in state else F.col(c) for c in target.columns]
    return target.join(new, "url", "left").select(*keep)


def resolve_fetches(attempts: DataFrame, key: str = "url") -> DataFrame:
    """What a log of fetch attempts means for each digest.

    ``attempts``: key, primary_url, request_url, attempt, cand_rank, http_status
    (null for an exception), error, bytes, fetched_at. Within an attempt the
    candidates are walked by rank: 200 completes, 404 goes on, an exception is
    remembered, any other status ends the attempt. An attempt with nothing but
    404s settles the digest as failed. The first attempt that settles it counts,
    else the last one.

    Both steps are aggregates that combine before their shuffle.
    """
    status, rank = F.col("http_status"), F.col("cand_rank")
    ends = F.when(status.isNotNull() & (status != 404), rank)
    threw = F.when(status.isNull(), rank)
    per_attempt = attempts.groupBy(key, "attempt").agg(
        F.min_by(F.struct("http_status", "request_url", "primary_url", "bytes", "fetched_at"),
                 ends).alias("end"),
        F.max_by(F.coalesce("error", F.lit("")), threw).alias("last_error"),
    )

    end = F.col("end")
    completed = F.coalesce(end["http_status"] == 200, F.lit(False))
    gone = end.isNull() & F.col("last_error").isNull()
    fallback = end["request_url"] != end["primary_url"]
    verdict = F.struct(
        "attempt",
        F.when(completed, "completed").otherwise("failed").alias("status"),
        F.when(completed, F.when(fallback, F.concat(F.lit("Fallback URL used: "), end["request_url"])))
        .when(end.isNotNull(), F.concat(F.lit("HTTP "), end["http_status"].cast("string")))
        .otherwise(F.coalesce("last_error", F.lit(NOT_FOUND))).alias("message"),
        F.when(completed, end["bytes"]).alias("bytes"),
        F.when(completed, end["fetched_at"]).alias("fetched_at"),
    )
    chosen = (
        per_attempt.select(key, "attempt", verdict.alias("v"), (completed | gone).alias("settled"))
        .groupBy(key)
        .agg(
            F.coalesce(F.min_by("v", F.when(F.col("settled"), F.col("attempt"))),
                       F.max_by("v", "attempt")).alias("v"),
            F.min("attempt").alias("first"),
        )
    )
    return chosen.select(
        key,
        F.col("v.status").alias("status"),
        (F.col("v.attempt") - F.col("first") + 1).alias("attempts"),
        F.col("v.message").alias("message"),
        F.col("v.bytes").alias("file_size_bytes"),
        F.col("v.fetched_at").alias("downloaded_at"),
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Rows and bytes by status."""
    return manifest.groupBy("download_status").agg(
        F.count("*").alias("cnt"),
        F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("total_bytes"),
    )


def download_stats(batch: DataFrame, results: DataFrame, skipped_failed: DataFrame) -> DataFrame:
    """One row of counts of a download run.

    ``results`` carry download_status, ``skipped_failed`` are the rows left out.
    """
    def tagged(df: DataFrame, status: Column) -> DataFrame:
        return df.select(status.alias("s"))

    rows = (
        tagged(results, F.col("download_status"))
        .unionAll(tagged(skipped_failed, F.lit("skipped_failed")))
        .unionAll(tagged(batch, F.lit("total")))
    )
    names = ["completed", "failed", "skipped", "skipped_failed", "total"]
    return rows.agg(*[F.count_if(F.col("s") == n).alias(n) for n in names])
