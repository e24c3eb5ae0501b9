"""Registered queries: calendar, addresses, manifest and attempt logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketlake.functions import urls
from docketlake.operators import extraction as E, manifest as M, parsing as P
from docketlake.plans.inputs import view
from docketlake.plans.registry import query

ROOT = "https://archive.example/daily"


@query("manifest_calendar", """
    SELECT year, count(*) AS n_days, CAST(count(*) FILTER (isodow(d) < 6) AS BIGINT) AS n_weekdays,
      min(d) AS first_date, max(d) AS last_date
    FROM (SELECT year, CAST(unnest(generate_series(make_date(year, 1, 1), make_date(year, 12, 31),
            INTERVAL 1 DAY)) AS DATE) AS d
          FROM (SELECT DISTINCT year FROM <s_manifest>) y) c
    GROUP BY year""")
def manifest_calendar(spark, sf):
    days = M.calendar(view(spark, sf, "s_manifest").select("year").distinct())
    return days.groupBy("year").agg(
        F.count("*").alias("n_days"), F.count_if("is_weekday").alias("n_weekdays"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


_ERA = """
    SELECT *, CAST(year(date) AS INT) AS y, strftime(date, 'dig%m%d%y') AS stem,
      strftime(date, '%m-%d') AS md, year(date) = 2002 AND month(date) >= 2 AS late,
      'https://archive.example/daily/' AS root
    FROM <s_days>"""


@query("manifest_urls", f"""
    SELECT event_id, date, y AS year, ext,
      root || CASE WHEN late THEN md || '.txt' WHEN y BETWEEN 2003 AND 2006 THEN stem || '.txt'
        ELSE y || '/' || stem || '.' || ext END AS url,
      'raw/' || y || '/digest_' || CAST(date AS VARCHAR) || '.' || ext AS local_path
    FROM (SELECT *, CASE WHEN y >= 2007 THEN 'htm' WHEN y >= 2003 OR late THEN 'txt' ELSE 'pdf' END AS ext
          FROM ({_ERA}) e) x""")
def manifest_urls(spark, sf):
    days = view(spark, sf, "s_days")
    day = F.col("date")
    return days.select("event_id", day, F.year(day).alias("year"), urls.file_extension(day).alias("ext"),
                       urls.digest_url(day, ROOT).alias("url"), urls.local_path(day).alias("local_path"))


@query("manifest_candidates", f"""
    SELECT event_id, date, CAST(generate_subscripts(c, 1) AS INT) AS cand_rank, root || unnest(c) AS url
    FROM (SELECT *, CASE
            WHEN late THEN [md || '.txt']
            WHEN y <= 2002 THEN [y || '/' || stem || '.pdf', stem || '.pdf']
            WHEN y <= 2006 THEN [stem || '.txt', y || '/' || stem || '.txt', y || '/' || stem || '.htm', stem || '.htm']
            WHEN y <= 2008 THEN [y || '/' || stem || '.txt', stem || '.txt', y || '/' || stem || '.htm', stem || '.htm']
            ELSE [y || '/' || stem || '.htm', y || '/' || stem || '.txt', stem || '.txt', stem || '.htm'] END AS c
          FROM ({_ERA}) e) x""")
def manifest_candidates(spark, sf):
    return M.candidates(view(spark, sf, "s_days"), ROOT).withColumnRenamed("candidate_url", "url")


@query("manifest_insert", """
    WITH target AS (SELECT url, year, download_status FROM <s_manifest> WHERE event_id % 2 = 0),
    batch AS (SELECT concat('u/', event_id - event_id % 3) AS url, arg_min(year, event_id) AS year
              FROM <s_manifest> GROUP BY 1)
    SELECT url, year, download_status FROM target
    UNION ALL
    SELECT url, year, 'pending' FROM batch WHERE url NOT IN (SELECT url FROM target)""")
def manifest_insert(spark, sf):
    m = view(spark, sf, "s_manifest")
    target = m.where("event_id % 2 = 0").select("url", "year", "download_status", "event_id")
    batch = m.select(
        F.concat(F.lit("u/"), (F.col("event_id") - F.col("event_id") % 3).cast("string")).alias("url"),
        "year", F.lit("pending").alias("download_status"), "event_id")
    return M.insert_missing(target, batch, F.col("event_id")).select("url", "year", "download_status")


@query("manifest_update", """
    SELECT url,
      CASE WHEN event_id % 3 = 0 THEN CASE event_id % 2 WHEN 0 THEN 'completed' ELSE 'skipped' END
        ELSE download_status END AS download_status,
      CASE WHEN event_id % 3 = 0 THEN event_id % 777 ELSE file_size_bytes END AS file_size_bytes,
      CASE WHEN event_id % 3 = 0 AND event_id % 2 = 0 THEN NULL ELSE downloaded_at END AS downloaded_at,
      CASE WHEN event_id % 3 = 0 AND event_id % 2 = 0 THEN 'Fallback URL used: x' ELSE error_message END AS error_message
    FROM <s_manifest>""")
def manifest_update(spark, sf):
    m = view(spark, sf, "s_manifest")
    done = (F.col("event_id") % 2) == 0
    results = m.where("event_id % 3 = 0").select(
        # One in six results names a url that the manifest does not know.
        F.explode(F.array(F.col("url"), F.concat(F.lit("x/"), F.col("url")))).alias("url"),
        F.when(done, "completed").otherwise("skipped").alias("download_status"),
        (F.col("event_id") % 777).alias("file_size_bytes"),
        F.lit(None).cast("timestamp_ntz").alias("downloaded_at"),
        F.when(done, "Fallback URL used: x").alias("error_message"))
    return M.update_manifest(m, results, F.struct("download_status", "file_size_bytes")).select(
        "url", "download_status", "file_size_bytes", "downloaded_at", "error_message")


@query("manifest_summary", """
    SELECT download_status, count(*) AS cnt, CAST(coalesce(sum(file_size_bytes), 0) AS BIGINT) AS total_bytes
    FROM <s_manifest> GROUP BY 1""")
def manifest_summary(spark, sf):
    return M.manifest_summary(view(spark, sf, "s_manifest"))


@query("skip_known_failed", """
    SELECT url, year FROM <s_manifest>
    WHERE event_id % 4 = 0 OR download_status <> 'failed'""")
def skip_known_failed(spark, sf):
    m = view(spark, sf, "s_manifest")
    return M.without_failed(m, m.where("event_id % 4 <> 0")).select("url", "year")


@query("skip_known_failed_404", """
    SELECT url, year FROM <s_manifest>
    WHERE download_status <> 'failed' OR error_message NOT LIKE '404%'""")
def skip_known_failed_404(spark, sf):
    m = view(spark, sf, "s_manifest")
    return M.without_failed(m, m, retry_non_404=True).select("url", "year")


@query("skip_existing", """
    SELECT local_path FROM <s_manifest>
    WHERE local_path NOT IN (SELECT pdf_path FROM <s_parsing>)""")
def skip_existing(spark, sf):
    done = view(spark, sf, "s_parsing").select(F.col("pdf_path").alias("local_path"))
    return P.skip_existing(view(spark, sf, "s_manifest"), done, "local_path").select("local_path")


@query("mark_existing", """
    SELECT m.local_path, p.markdown_length, 'skipped' AS status
    FROM <s_manifest> m JOIN <s_parsing> p ON m.local_path = p.pdf_path""")
def mark_existing(spark, sf):
    done = view(spark, sf, "s_parsing").select(F.col("pdf_path").alias("local_path"), "markdown_length")
    work = view(spark, sf, "s_manifest").select("local_path")
    return P.mark_existing(work, done, "local_path", "markdown_length")


@query("year_filter", """
    SELECT year, count(*) AS cnt FROM <s_manifest> WHERE year BETWEEN 1980 AND 1999 GROUP BY 1""")
def year_filter(spark, sf):
    rows = M.in_years(view(spark, sf, "s_manifest"), 1980, 1999)
    return rows.groupBy("year").agg(F.count("*").alias("cnt"))


@query("fetch_resolution", """
    WITH per_attempt AS (
      SELECT work_id, attempt,
        min(cand_rank) FILTER (http_status IS NOT NULL AND http_status <> 404) AS end_rank,
        max(cand_rank) FILTER (http_status IS NULL) AS error_rank
      FROM <s_fetches> GROUP BY 1, 2),
    judged AS (
      SELECT p.work_id, p.attempt, e.http_status AS code, e.request_url, e.bytes, e.fetched_at,
        CASE WHEN e.http_status = 200 THEN 'completed'
          WHEN e.http_status IS NULL AND x.work_id IS NULL THEN 'gone' ELSE 'retry' END AS verdict,
        CASE WHEN e.http_status = 200 THEN
            CASE WHEN e.cand_rank > 1 THEN 'Fallback URL used: ' || e.request_url END
          WHEN e.http_status IS NOT NULL THEN 'HTTP ' || e.http_status
          WHEN x.work_id IS NOT NULL THEN x.error
          ELSE '404 Not Found (likely weekend/holiday)' END AS message
      FROM per_attempt p
      LEFT JOIN <s_fetches> e ON e.work_id = p.work_id AND e.attempt = p.attempt AND e.cand_rank = p.end_rank
      LEFT JOIN <s_fetches> x ON x.work_id = p.work_id AND x.attempt = p.attempt AND x.cand_rank = p.error_rank),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY
          verdict = 'retry', CASE WHEN verdict = 'retry' THEN -attempt ELSE attempt END) AS rn,
        min(attempt) OVER (PARTITION BY work_id) AS first_attempt
      FROM judged)
    SELECT work_id, CASE verdict WHEN 'completed' THEN 'completed' ELSE 'failed' END AS status,
      attempt - first_attempt + 1 AS attempts, message,
      CASE verdict WHEN 'completed' THEN bytes END AS file_size_bytes,
      CASE verdict WHEN 'completed' THEN fetched_at END AS downloaded_at
    FROM ranked WHERE rn = 1""")
def fetch_resolution(spark, sf):
    return M.resolve_fetches(view(spark, sf, "s_fetches"), "work_id")


@query("retry_resolution", """
    WITH judged AS (
      SELECT work_id, attempt,
        CASE WHEN http_status IS NULL THEN 'error' WHEN http_status = 200 AND valid THEN 'ok'
          WHEN http_status IN (503, 429, 500, 502, 504) THEN 'retry' ELSE 'failed' END AS verdict,
        CASE WHEN http_status IS NULL THEN error WHEN http_status <> 200 THEN 'HTTP ' || http_status
          WHEN NOT valid THEN 'invalid answer' END AS message
      FROM <s_calls>),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY
          verdict = 'retry', CASE WHEN verdict = 'retry' THEN -attempt ELSE attempt END) AS rn,
        min(attempt) OVER (PARTITION BY work_id) AS first_attempt
      FROM judged)
    SELECT work_id, CASE verdict WHEN 'retry' THEN 'failed' ELSE verdict END AS status,
      attempt - first_attempt + 1 AS attempts, message
    FROM ranked WHERE rn = 1""")
def retry_resolution(spark, sf):
    return E.resolve_calls(view(spark, sf, "s_calls"), "work_id", F.col("valid"))


@query("retry_schedule", """
    SELECT work_id, attempt, coalesce(http_status IN (503, 429, 500, 502, 504), false) AS retryable,
      CAST(2 * power(2, attempt) AS DOUBLE) AS base_delay_s, true AS jitter_in_bounds
    FROM <s_calls>""")
def retry_schedule(spark, sf):
    plan = E.retry_schedule(view(spark, sf, "s_calls"), "work_id")
    in_bounds = F.col("wait_s").between(F.col("base_delay_s"), F.col("base_delay_s") * 1.25)
    return plan.select("work_id", "attempt", "retryable", "base_delay_s",
                       in_bounds.alias("jitter_in_bounds"))


@query("download_stats", """
    SELECT count(*) FILTER (download_status = 'completed') AS completed,
      count(*) FILTER (download_status = 'failed' AND event_id % 4 = 0) AS failed,
      count(*) FILTER (download_status = 'skipped') AS skipped,
      count(*) FILTER (download_status = 'failed' AND event_id % 4 <> 0) AS skipped_failed,
      count(*) AS total
    FROM <s_manifest>""")
def download_stats(spark, sf):
    m = view(spark, sf, "s_manifest")
    known_failed = m.where("event_id % 4 <> 0 AND download_status = 'failed'")
    tried = M.without_failed(m, m.where("event_id % 4 <> 0"))
    return M.download_stats(m, tried, known_failed)


# --- parse results -----------------------------------------------------------

@query("parse_summary", """
    SELECT parsing_status, count(*) AS cnt, round(nullif(avg(page_count), 0), 1) AS avg_pages,
      round(nullif(avg(markdown_length), 0), 1) AS avg_length
    FROM <s_parsing> GROUP BY 1""")
def parse_summary(spark, sf):
    return P.parse_summary(view(spark, sf, "s_parsing"))


@query("parse_stats", """
    SELECT count(*) FILTER (parsing_status = 'completed') AS completed,
      count(*) FILTER (parsing_status = 'failed') AS failed,
      count(*) FILTER (parsing_status = 'skipped') AS skipped,
      CAST(0 AS BIGINT) AS needs_converter, count(*) AS total
    FROM <s_parsing>""")
def parse_stats(spark, sf):
    return P.parse_stats(view(spark, sf, "s_parsing"))


@query("parse_upsert", """
    WITH o AS (SELECT * FROM <s_parsing> WHERE event_id % 3 <> 0),
    n AS (SELECT event_id, pdf_path, CASE event_id % 2 WHEN 0 THEN 'skipped' ELSE 'completed' END AS parsing_status,
            CASE WHEN event_id % 2 = 1 THEN 77 END AS page_count, markdown_length + 1 AS markdown_length
          FROM <s_parsing> WHERE event_id % 3 <> 1)
    SELECT coalesce(n.pdf_path, o.pdf_path) AS pdf_path,
      CASE WHEN n.pdf_path IS NULL THEN o.parsing_status ELSE n.parsing_status END AS parsing_status,
      CAST(CASE WHEN n.pdf_path IS NULL THEN o.page_count WHEN n.parsing_status = 'skipped'
        THEN coalesce(n.page_count, o.page_count) ELSE n.page_count END AS INT) AS page_count,
      CAST(CASE WHEN n.pdf_path IS NULL THEN o.markdown_length ELSE n.markdown_length END AS INT) AS markdown_length
    FROM o FULL JOIN n ON o.pdf_path = n.pdf_path""")
def parse_upsert(spark, sf):
    rows = view(spark, sf, "s_parsing")
    columns = [c for c in rows.columns if c != "event_id"]
    skipped = (F.col("event_id") % 2) == 0
    new = (
        rows.where("event_id % 3 <> 1")
        .withColumn("parsing_status", F.when(skipped, "skipped").otherwise("completed"))
        .withColumn("page_count", F.when(~skipped, 77))
        .withColumn("markdown_length", F.col("markdown_length") + 1)
    )
    merged = P.upsert_results(rows.where("event_id % 3 <> 0").select(columns), new.select(columns),
                              F.struct("parsing_status", "markdown_length"))
    return merged.select("pdf_path", "parsing_status", "page_count", "markdown_length")
