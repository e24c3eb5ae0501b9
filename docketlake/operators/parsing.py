"""Raw files to plain text, and the table of parse results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docketlake.functions import text as X, urls
from docketlake.functions.html import html_to_text
from docketlake.operators.keys import apart, first_per_key, missing_from


def parse_files(raw: DataFrame, output: str = "markdown", pdf_text: DataFrame | None = None,
                keep_script_text: bool = False) -> DataFrame:
    """Text of every raw file (``path``, ``content`` as bytes) with its outcome.

    PDF conversion is the caller's: ``pdf_text`` (path, text, page_count) supplies
    it; a PDF without a row there gets the outcome ``needs_converter``.
    """
    kind = urls.source_kind(F.col("path"))
    decoded = X.decode_bytes(F.col("content"))
    text = F.when(kind == "text", decoded).when(
        kind == "html", html_to_text(decoded, keep_script_text))
    parsed = raw.select(
        "path", kind.alias("kind"), urls.text_path(F.col("path"), output).alias("out_path"),
        urls.year_folder(F.col("path")).alias("year_dir"),
        urls.file_suffix(F.col("path")).alias("_suffix"), text.alias("text"),
        F.lit(None).cast("int").alias("page_count"),
    )
    if pdf_text is not None:
        converted = pdf_text.select("path", F.col("text").alias("_text"),
                                    F.col("page_count").alias("_pages"))
        is_pdf = F.col("kind") == "pdf"
        pdfs = (
            parsed.where(is_pdf).join(converted, "path", "left")
            .withColumn("text", F.col("_text")).withColumn("page_count", F.col("_pages"))
            .select(*parsed.columns)
        )
        parsed = parsed.where(~is_pdf).unionByName(pdfs)
    status = (
        F.when(F.col("kind") == "unsupported", "failed")
        .when(F.col("text").isNull(), "needs_converter")
        .otherwise("completed")
    )
    message = F.when(F.col("kind") == "unsupported",
                     F.concat(F.lit("Unsupported file type: "), F.col("_suffix")))
    return parsed.select(
        "path", "year_dir", "kind", "out_path", "text", "page_count",
        status.alias("parsing_status"), F.length("text").alias("markdown_length"),
        message.alias("error_message"),
    )


def to_results(parsed: DataFrame, parsed_at: Column) -> DataFrame:
    """Rows of the parse-result table for parsed files."""
    return parsed.select(
        F.col("path").alias("pdf_path"), F.col("out_path").alias("markdown_path"),
        "parsing_status", "page_count", "markdown_length",
        F.when(F.col("parsing_status") == "completed", parsed_at).alias("parsed_at"),
        "error_message",
    )


def skip_existing(work: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Work items whose output is not there yet."""
    return missing_from(work, existing, key)


def mark_existing(work: DataFrame, existing: DataFrame, key: str, size: str) -> DataFrame:
    """Work items whose output is there, as ``skipped`` with the size of that output."""
    sizes = existing.groupBy(key, apart(key)).agg(F.max(size).alias(size)).drop("_apart")
    kept = [c for c in work.columns if c != size]
    return work.select(*kept).join(sizes, key).withColumn("status", F.lit("skipped"))


def one_per_output(parsed: DataFrame) -> DataFrame:
    """Of several completed files of one ``out_path`` the first by path is kept.

    The files after it become ``skipped``, with the length of the text that is kept.
    Files before it, which gave no text, stay as they are.
    """
    done = parsed.where(F.col("parsing_status") == "completed")
    first = done.groupBy("out_path").agg(
        F.min(F.struct(F.col("path").alias("path"), F.col("markdown_length").alias("size"))).alias("_first"))
    after = F.coalesce(F.col("path") > F.col("_first.path"), F.lit(False))
    changed = {
        "parsing_status": F.lit("skipped"), "markdown_length": F.col("_first.size"),
        "page_count": F.lit(None), "error_message": F.lit(None),
    }
    return parsed.join(first, "out_path", "left").select(
        *[F.when(after, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else c for c in parsed.columns])


def upsert_results(old: DataFrame, new: DataFrame, order: Column) -> DataFrame:
    """Replace or add parse results by ``pdf_path``; the last copy in ``new`` by ``order`` wins.

    A ``skipped`` result keeps the page count, time and message of the stored row.
    """
    key = "pdf_path"
    columns = [c for c in old.columns if c != key]
    sticky = {"page_count", "parsed_at", "error_message"}
    latest = first_per_key(new.select(key, *columns), key, order, last=True)
    o = old.select(key, F.struct(*columns).alias("_old"))
    n = latest.select(key, F.struct(*columns).alias("_new"))
    hit, skipped = F.col("_new").isNotNull(), F.col("_new.parsing_status") == "skipped"

    def value(c: str) -> Column:
        changed = F.col(f"_new.{c}")
        if c in sticky:
            changed = F.when(skipped, F.coalesce(changed, F.col(f"_old.{c}"))).otherwise(changed)
        return F.when(hit, changed).otherwise(F.col(f"_old.{c}")).alias(c)

    return o.join(n, key, "full").select(key, *[value(c) for c in columns]).select(*old.columns)


def parse_summary(results: DataFrame) -> DataFrame:
    """Rows, mean pages and mean length by status; a mean of 0 counts as missing."""
    def mean(c: str) -> Column:
        return F.round(F.nullif(F.avg(c), F.lit(0.0)), 1)

    return results.groupBy("parsing_status").agg(
        F.count("*").alias("cnt"),
        mean("page_count").alias("avg_pages"),
        mean("markdown_length").alias("avg_length"),
    )


def parse_stats(results: DataFrame) -> DataFrame:
    """One row of counts of a parse run."""
    s = F.col("parsing_status")
    return results.agg(
        *[F.count_if(s == n).alias(n) for n in ("completed", "failed", "skipped", "needs_converter")],
        F.count("*").alias("total"),
    )
