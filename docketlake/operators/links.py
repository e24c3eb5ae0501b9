"""Inventory of the links on archive pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docketlake.functions import urls
from docketlake.functions.html import anchors, resolve_link


def page_links(pages: DataFrame) -> DataFrame:
    """One row per anchor of a page (``page_id``, ``url``, ``html``), in page order."""
    found = pages.select("page_id", F.col("url").alias("page_url"),
                         F.posexplode(anchors(F.col("html"))).alias("pos", "_a"))
    return found.select("page_id", "page_url", "pos", "_a.href", "_a.text")


def pdf_links(links: DataFrame) -> DataFrame:
    return links.where(F.col("href").rlike(urls.PDF_LINK))


def year_links(links: DataFrame, year: int | str) -> DataFrame:
    """Links that name the year in their address or text."""
    token = F.lit(str(year))
    return links.where(F.contains("href", token) | F.contains("text", token))


def resolved(links: DataFrame, base: str = "page_url") -> DataFrame:
    return links.withColumn("full_url", resolve_link(F.col(base), F.col("href")))


def digest_links(links: DataFrame, column: str = "href") -> DataFrame:
    """Links to a daily digest with the year, month and day in their address."""
    parts = links.withColumn("_p", urls.digest_link_parts(F.col(column)))
    return parts.where(F.col("_p").isNotNull()).select(*links.columns, "_p.*")


def year_index_links(links: DataFrame) -> DataFrame:
    return links.where(F.col("href").rlike(urls.YEAR_INDEX_LINK))


def link_counts(pages: DataFrame) -> DataFrame:
    """All links and PDF links of each page, 0 where it has none. No shuffle."""
    found = pages.select("page_id", anchors(F.col("html")).alias("_a"))
    pdf = F.filter("_a", lambda a: a["href"].rlike(urls.PDF_LINK))
    return found.select(
        "page_id",
        F.coalesce(F.size("_a"), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.size(pdf), F.lit(0)).cast("bigint").alias("n_pdf"),
    )
