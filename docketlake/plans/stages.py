"""The stages of the pipeline over stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from docketlake.functions import urls
from docketlake.operators import calls as C, extraction as E, load as L, manifest as M, parsing as P, reports as R
from docketlake.operators.keys import distinct_keys
from docketlake.schemas import MANIFEST, PARSING
from docketlake.session import configure, drop_scratch, scratch_path
from docketlake.sources import files, tables as T
from docketlake.sources.pending import read_pending

TEXTS = "pdf_path STRING, out_path STRING, digest_date DATE, text STRING, text_length INT, year INT"


def plan_downloads(spark: SparkSession, base: str, url_root: str, first: int, last: int,
                   output: str = "raw", retry_non_404: bool = False) -> DataFrame:
    """Register the days of a range of years and return what is left to fetch.

    The result has one row per day and candidate address, best first.
    """
    configure(spark)
    T.finish_published(spark, base)
    years = M.in_years(spark.range(first, last + 1).select(F.col("id").cast("int").alias("year")),
                       first, last)
    batch = M.build_manifest(M.calendar(years), url_root, output)
    path = f"{base}/download_manifest"
    known = M.in_years(T.read_or_empty(spark, path, MANIFEST), first, last)
    T.publish(spark, base, {"download_manifest": (M.insert_missing(known, batch, F.col("date")), ["year"])})
    stored = M.in_years(T.read_or_empty(spark, path, MANIFEST), first, last)
    return M.candidates(M.without_failed(batch, stored, retry_non_404), url_root)


def record_downloads(spark: SparkSession, base: str, attempts: DataFrame) -> DataFrame:
    """Resolve a log of fetch attempts into the manifest, rewriting only its years.

    Returns the counts of the run over the manifest rows of those years: what the log
    resolved, rows downloaded before (``skipped``), rows left out as they failed before
    (``skipped_failed``), and all rows (``total``).
    """
    configure(spark)
    T.finish_published(spark, base)
    resolved = scratch_path(spark, "resolved")
    M.resolve_fetches(attempts).select(
        "url", F.col("status").alias("download_status"), "file_size_bytes", "downloaded_at",
        F.col("message").alias("error_message")).write.parquet(resolved)
    results = spark.read.parquet(resolved)
    target = T.read_or_empty(spark, f"{base}/download_manifest", MANIFEST)
    # At most one value per year of the archive.
    touched = target.select("url", "year").join(results.select("url"), "url", "left_semi")
    years = [r.year for r in touched.select("year").distinct().collect()]
    target = target.where(F.col("year").isin(years))
    rest = P.skip_existing(target, results, "url")
    stats = M.download_stats(
        target,
        target.join(results.select("url", F.col("download_status").alias("_s")), "url").select(
            F.col("_s").alias("download_status")).unionByName(
            rest.where("download_status IN ('completed', 'skipped')").select(F.lit("skipped").alias("download_status"))),
        rest.where("download_status = 'failed'"))
    counts = spark.createDataFrame([stats.first()], stats.schema)
    if years:
        order = F.struct("downloaded_at", "download_status", "file_size_bytes", "error_message")
        T.publish(spark, base, {"download_manifest": (M.update_manifest(target, results, order), ["year"])})
    drop_scratch(spark, resolved)
    return counts


def parse_year(spark: SparkSession, base: str, raw_root: str, year: int,
               pdf_text: DataFrame | None = None) -> DataFrame:
    """Parse the new raw files of a year, store texts and results, return run counts.

    A digest is known by its output path. Of several files with one output path the
    first that gives a text is kept, the files after it are ``skipped``, in this run
    and in later ones. Only files that are parsed are opened. Texts and results are put in
    place together: what a run that died had staged, this one stores first.
    """
    configure(spark)
    T.finish_published(spark, base)
    text_path, result_path = f"{base}/digest_text", f"{base}/parsing_results"
    raw = files.raw_files(spark, raw_root, year).drop("content").withColumn(
        "out_path", urls.text_path(F.col("path"), "markdown"))
    done = T.read_or_empty(spark, text_path, TEXTS).where(F.col("year") == year).select(
        "out_path", F.col("text_length").alias("markdown_length"))
    names = raw.select("path", "out_path", "file")
    new_names = P.skip_existing(names, done, "out_path")
    is_pdf = urls.source_kind(F.col("path")) == "pdf"
    pending, staged = scratch_path(spark, "pending"), scratch_path(spark, "parsed")
    opened = read_pending(spark, new_names.where(~is_pdf), pending).unionByName(
        new_names.where(is_pdf).select("path", F.lit(None).cast("binary").alias("content")))
    P.parse_files(opened, pdf_text=pdf_text).write.parquet(staged)
    parsed = spark.read.parquet(staged)
    columns = ["path", "out_path", "parsing_status", "page_count", "markdown_length", "error_message"]
    judged = P.one_per_output(parsed.select(*columns))
    skipped = P.mark_existing(names.select("path", "out_path"), done, "out_path", "markdown_length").select(
        "path", "out_path", F.col("status").alias("parsing_status"), F.lit(None).cast("int").alias("page_count"),
        "markdown_length", F.lit(None).cast("string").alias("error_message"))
    # Read twice below, and the texts it looks at are about to change.
    result_stage = scratch_path(spark, "results")
    P.to_results(judged.unionByName(skipped), F.current_timestamp().cast("timestamp_ntz")).write.parquet(result_stage)
    new = spark.read.parquet(result_stage)
    kept = judged.where(F.col("parsing_status") == "completed").select("path")
    texts = parsed.join(kept, "path", "left_semi").select(
        F.col("path").alias("pdf_path"), "out_path", urls.digest_date_from_name(F.col("path")).alias("digest_date"),
        "text", F.col("markdown_length").alias("text_length"), F.lit(year).alias("year"),
        F.lit(f"b{uuid.uuid4().hex}").alias("batch"))
    old = T.read_or_empty(spark, result_path, f"{PARSING}, year INT").where(
        F.col("year") == year).drop("year")
    merged = P.upsert_results(old, new, F.struct(
        "parsed_at", "parsing_status", "markdown_length", "markdown_path", "error_message")).withColumn("year", F.lit(year))
    counts = P.parse_stats(new)
    row = spark.createDataFrame([counts.first()], counts.schema)
    T.publish(spark, base, {"digest_text": (texts, ["year", "batch"]), "parsing_results": (merged, ["year"])})
    drop_scratch(spark, pending, staged, result_stage)
    return row


def extract_texts(spark: SparkSession, base: str, make_client: Callable[[], Callable[[str], str]],
                  year: int | None = None, limit: int | None = None, retry_failed: bool = False,
                  concurrency: int | None = None, store_negative: bool = False,
                  batch: int = C.BATCH) -> DataFrame:
    """Extract the pending digests, store their records, return the outcomes.

    The outcomes go to ``extraction_outcomes`` (with attempts and the path of what was
    invalid), the run's counts by year to ``extraction_stats``. ``store_negative`` also
    stores an empty record for every digest in which the pre-filter finds no section.

    Digests, calls and records are known by the output path of the text. Digests whose
    extraction failed have a record and are left alone, unless ``retry_failed``. Those
    in error have none and are tried again; those whose file name holds no date are in
    error without a call. The calls of a run are logged batch by batch: a run that died is
    finished first, whatever the year of its prompts, and asks again for one batch at most.
    """
    configure(spark)
    T.finish_published(spark, base)
    texts = files.read_texts(spark, f"{base}/digest_text", year)
    record_path, open_path = f"{base}/extractions", f"{base}/call_log_open"
    if files.path_exists(spark, record_path):
        done = files.read_extractions(spark, record_path)
        if retry_failed:
            done = done.where(L.has_actions() | ~F.col("has_enforcement_actions"))
        done = done.select("out_path")
    else:
        done = spark.createDataFrame([], "out_path STRING")
    dated = F.col("digest_date").isNotNull()

    # A run's mark holds its prompts, and goes when its records are stored.
    calls, left = f"{base}/call_log", []
    for name in files.marks(spark, open_path):
        if files.path_exists(spark, f"{open_path}/{name}/prompts/_SUCCESS"):
            left.append(name)
        else:
            files.drop_folder(spark, f"{open_path}/{name}")

    def ask(name: str) -> DataFrame:
        mark = f"{open_path}/{name}"
        C.call_in_batches(spark, f"{mark}/prompts", f"{calls}/run={name}", f"{mark}/checkpoint", make_client,
                          concurrency=concurrency)
        return C.read_log(spark, f"{calls}/run={name}").drop("last", "batch")

    pending, paid_path = texts.where(dated), scratch_path(spark, "paid")
    if left:
        paid = reduce(DataFrame.unionByName, [ask(name) for name in left])
        # Staged, since the records that it is compared with are about to grow.
        P.skip_existing(paid, done.withColumnRenamed("out_path", "prompt_key"), "prompt_key").write.parquet(paid_path)
        paid = spark.read.parquet(paid_path)
        pending = P.skip_existing(pending, paid.select(F.col("prompt_key").alias("out_path")), "out_path")
    run = f"r{uuid.uuid4().hex}"
    work = E.prompts(E.pending_digests(pending, done, "out_path", limit))
    C.store_prompts(work.select(F.col("out_path").alias("prompt_key"), "prompt"), f"{open_path}/{run}/prompts", batch)
    log = ask(run)
    if left:
        log = log.unionByName(paid)

    digest = [F.col("prompt_key").alias("out_path"), urls.digest_date_from_name(F.col("prompt_key")).alias("digest_date")]
    answered = log.where(F.col("http_status") == 200).select(
        *digest, "response", (F.col("attempt") + 1).alias("attempts"))
    outcomes = E.extraction_outcomes(answered, "out_path", "digest_date", "attempts")

    def without_answer(rows: DataFrame, note: Column, outcome: Column, error: str) -> DataFrame:
        return rows.select(
            "out_path", "digest_date", "attempts", F.lit(True).alias("has_enforcement_actions"),
            F.lit([]).cast(outcomes.schema["actions"].dataType).alias("actions"),
            F.concat(F.lit("Extraction failed: "), note).alias("extraction_notes"),
            outcome.alias("outcome"), F.lit(error).alias("error_class"),
            F.lit(None).cast("string").alias("error_path"))

    dead = E.resolve_calls(log, "prompt_key", F.lit(True)).where("status <> 'ok'").select(
        *digest, "attempts", "message", "status")
    undated = E.prefilter(texts.where(~dated)).where("has_actions").select(
        "out_path", "digest_date", F.lit(0).alias("attempts"))
    result = outcomes.unionByName(
        without_answer(dead, F.col("message"), F.col("status"), "ResponseError")
    ).unionByName(
        without_answer(undated, F.lit("no digest date in the file name"), F.lit("error"), "ValueError")
    ).withColumn("year", F.coalesce(F.year("digest_date"), urls.year_folder(F.col("out_path")).try_cast("int")))
    stored = result.where(F.col("outcome").isin("ok", "failed")).select(
        "digest_date", "has_enforcement_actions", "actions", "extraction_notes", "out_path", "year")
    if store_negative:
        empty = E.without_sections(P.skip_existing(texts.where(dated), done, "out_path"), "out_path")
        stored = stored.unionByName(empty.withColumn("year", F.year("digest_date")))
    outcome_path, stats_path = f"{base}/extraction_outcomes/run={run}", f"{base}/extraction_stats/run={run}"
    result.write.parquet(outcome_path)
    result = spark.read.parquet(outcome_path)
    had_record = texts.select("out_path", "year").join(distinct_keys(done, "out_path"), "out_path", "left_semi").select("year")
    E.extraction_stats(result, had_record).write.parquet(stats_path)
    files.write_extractions(stored, record_path)
    for name in [run, *left]:
        files.drop_folder(spark, f"{open_path}/{name}")
    return result


def load_records(spark: SparkSession, base: str, digests: DataFrame, order: list[str],
                 replace_years: list[int] | None = None, run: str | None = None) -> DataFrame:
    """Load nested records into the four tables; return the run's counts.

    ``order`` names the columns that fix the order of the ids. With ``replace_years`` those
    years are loaded anew in place of what is stored; an empty input is then refused.
    Digests in error go to ``load_rejects`` with the reason. ``run`` names the load: under a
    name that is committed nothing is loaded again, and its counts are returned. If another
    load was committed since this one began, this one is refused; so is one whose rows break
    the keys of the tables.
    """
    configure(spark)
    run = run or f"r{uuid.uuid4().hex}"
    earlier = T.loads(spark, base).where(F.col("load") == run).select(*T.COUNTS).first()
    if earlier:
        return spark.createDataFrame([earlier])
    before, ids = T.last_load(spark, base), T.last_ids(spark, base)
    days = T.loaded_days(spark, base)
    if replace_years:
        # Records without a date belong to no year, but are still errors to report.
        digests = digests.where(F.year("digest_date").isin(replace_years) | F.col("digest_date").isNull())
        days = days.where(~F.col("year").isin(replace_years))
    # Written once: the row number stays with its record from here on, and sizes are read
    # without the nested columns. The counts come from this write.
    staged, seen = scratch_path(spark, "load"), Observation()
    sized = L.with_sizes(L.classify(digests, days)).withColumn("_row", F.monotonically_increasing_id())
    sized.observe(seen, *L.load_metrics(sized.columns), *L.total_metrics()).where(
        F.col("load_outcome").isin("loaded", "error")).write.parquet(staged)
    classified, counts = spark.read.parquet(staged), seen.get
    if replace_years and counts["loaded"] == 0:
        raise ValueError("nothing to load in place of the stored years")
    chosen = classified.where(F.col("load_outcome") == "loaded")
    # The nested rows move once; the four tables are cut from what is stored here.
    placed_path = scratch_path(spark, "placed")
    L.with_offsets(chosen, [*order, "_row"]).withColumn("year", F.year("digest_date")).select(
        "digest_date", "year", "actions", "extraction_notes", *[f"{k}_offset" for k in L.KINDS]).write.parquet(placed_path)
    stored = spark.read.parquet(placed_path)

    def placed(*kinds: str) -> DataFrame:
        return stored.select("digest_date", "year", "actions", "extraction_notes", *[f"{k}_offset" for k in kinds])

    first = {t: n + 1 for t, n in ids.items()}
    rows = {t: counts["rows_" + ("actions" if t == "enforcement_actions" else t)] for t in ids}
    start = first["enforcement_actions"]
    actions = L.flatten_actions(placed("actions"), start).withColumn(
        "created_at", F.current_timestamp().cast("timestamp_ntz"))
    out = {"enforcement_actions": actions.select(
        "id", "digest_date", "action_type", "title", "settlement", "court", "case_number",
        "release_number", "full_text", "extraction_notes", "created_at", "year")}
    for kind, fields in L.CHILDREN.items():
        out[kind] = L.flatten_children(placed("actions", kind), kind, start, first[kind]).select(
            "id", "action_id", *fields, "year")
    n_days = T.write_load(spark, base, run, out, L.day_bitmaps(chosen),
                          classified.where(F.col("load_outcome") == "error"), first, rows)
    row = {c: counts.get(c) for c in T.COUNTS} | {"repeated_dates": counts["loaded"] - n_days}
    T.commit_load(spark, base, before, {**row, "load": run, "replaced_years": replace_years or [],
                                        "last_ids": {t: ids[t] + rows[t] for t in ids}})
    drop_scratch(spark, staged, placed_path)
    return spark.createDataFrame([tuple(row[c] for c in T.COUNTS)], ", ".join(f"{c} BIGINT" for c in T.COUNTS))


def load_extractions(spark: SparkSession, base: str, year: int | None = None,
                     full_reload: bool = False, whole_files: bool = False) -> DataFrame:
    """Load the stored records, all or those of one year, new dates only.

    ``whole_files``: the records are JSON files in year folders, one digest each.
    A full reload of a year leaves the others as they are; without a year it replaces all.
    """
    configure(spark)
    T.finish_published(spark, base)
    fmt = "files" if whole_files else "parquet"
    records = files.read_extractions(spark, f"{base}/extractions", year, fmt)
    years = None
    if full_reload:
        # Without a year all that is stored goes, also years that the records no longer have.
        years = [year] if year else _years(records, "digest_date")
        if years and not year:
            years = sorted({*years, *(r.year for r in T.loaded_days(spark, base).select("year").collect())})
    if whole_files:
        records = records.select("*", *files.load_order())
        return load_records(spark, base, records, ["year_dir", "file_name"], years)
    # Records of this package have no file of their own: the date leads, and the
    # record's content breaks ties between records of one date.
    keyed = records.withColumn("record_hash", F.xxhash64("actions", "extraction_notes"))
    return load_records(spark, base, keyed, ["digest_date", "record_hash"], years)


def _years(df: DataFrame, column: str) -> list[int]:
    """The years of a column of dates: one value per year of the archive."""
    return [r[0] for r in df.select(F.year(column)).distinct().collect() if r[0]]


def dashboard(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Every report over the stored tables; a table that is not there counts as empty."""
    configure(spark)
    t = T.enforcement_tables(spark, base)
    actions, respondents = t["enforcement_actions"], t["respondents"]
    manifest = T.read_or_empty(spark, f"{base}/download_manifest", MANIFEST)
    parsing = T.read_or_empty(spark, f"{base}/parsing_results", PARSING)
    return {
        "total_actions": R.total(actions),
        "digests_parsed": R.digests_parsed(parsing),
        "unique_respondents": R.unique_respondents(respondents),
        "settlement_rate": R.settlement_rate(actions),
        "actions_by_month": R.actions_by_month(actions).orderBy("month"),
        "action_types": R.action_types(actions),
        "sanction_types": R.sanction_types(t["sanctions"]),
        "entity_types": R.entity_types(respondents),
        "top_respondents": R.top_respondents(respondents),
        "top_statutes": R.top_statutes(t["violations"]),
        "settlement_by_type": R.settlement_by_type(actions),
        "files_on_disk": R.files_on_disk(manifest),
        "years_in_manifest": R.years_in_manifest(manifest),
        "parse_failures": R.parse_failures(parsing),
        "coverage_by_year": R.coverage_by_year(manifest).orderBy("year"),
        "parse_quality": R.parse_quality(parsing, manifest),
        "manifest_summary": M.manifest_summary(manifest),
        "parse_summary": P.parse_summary(parsing),
    }
