"""Registered queries: the reports and the link inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketlake.operators import links as K, load as L, reports as R
from docketlake.plans.inputs import FLAT_ACTIONS, nested_digests, table, view
from docketlake.plans.registry import query


def _title_sql(c: str) -> str:
    return f"""array_to_string(list_transform(string_split(replace({c}, '_', ' '), ' '),
      lambda w: array_to_string(list_transform(string_split(w, '-'), lambda h: upper(h[1]) || lower(h[2:])), '-')), ' ')"""


@query("total_actions", "SELECT count(*) AS n FROM <s_actions>")
def total_actions(spark, sf):
    return R.total(view(spark, sf, "s_actions"))


@query("digests_parsed", "SELECT count(*) AS n FROM <s_parsing> WHERE parsing_status IN ('completed', 'skipped')")
def digests_parsed(spark, sf):
    return R.digests_parsed(view(spark, sf, "s_parsing"))


@query("parse_failures", "SELECT count(*) AS n FROM <s_parsing> WHERE parsing_status = 'failed'")
def parse_failures(spark, sf):
    return R.parse_failures(view(spark, sf, "s_parsing"))


@query("files_on_disk", "SELECT count(*) AS n FROM <s_manifest> WHERE download_status IN ('completed', 'skipped')")
def files_on_disk(spark, sf):
    return R.files_on_disk(view(spark, sf, "s_manifest"))


@query("years_in_manifest", "SELECT count(DISTINCT year) AS n FROM <s_manifest>")
def years_in_manifest(spark, sf):
    return R.years_in_manifest(view(spark, sf, "s_manifest"))


@query("unique_respondents", "SELECT count(DISTINCT name) AS n FROM <s_respondents>")
def unique_respondents(spark, sf):
    return R.unique_respondents(view(spark, sf, "s_respondents"))


@query("settlement_rate", """
    SELECT settled, total, settled / total AS rate, concat(CAST(round(100 * settled / total) AS INT), '%') AS label
    FROM (SELECT count(*) FILTER (settlement) AS settled, count(settlement) AS total FROM <s_actions>) s""")
def settlement_rate(spark, sf):
    return R.settlement_rate(view(spark, sf, "s_actions"))


@query("actions_by_month", """
    SELECT CAST(date_trunc('month', digest_date) AS DATE) AS month, count(*) AS n FROM <s_actions> GROUP BY 1""")
def actions_by_month(spark, sf):
    return R.actions_by_month(view(spark, sf, "s_actions"))


@query("action_types", f"""
    SELECT action_type AS type, count(*) AS n, count(*) / (SELECT count(*) FROM <s_actions>) AS share,
      {_title_sql('action_type')} AS label
    FROM <s_actions> GROUP BY action_type""")
def action_types(spark, sf):
    return R.action_types(view(spark, sf, "s_actions"))


@query("entity_types", f"""
    SELECT type, n, n / sum(n) OVER () AS share, {_title_sql('type')} AS label
    FROM (SELECT coalesce(entity_type, 'unknown') AS type, count(*) AS n FROM <s_respondents> GROUP BY 1) t""")
def entity_types(spark, sf):
    return R.entity_types(view(spark, sf, "s_respondents"))


@query("sanction_types", f"""
    SELECT sanction_type, {_title_sql('sanction_type')} AS label, n, CAST(dense_rank() OVER (ORDER BY n) AS INT) AS rank
    FROM (SELECT sanction_type, count(*) AS n FROM <s_sanctions> WHERE sanction_type IS NOT NULL GROUP BY 1) t""")
def sanction_types(spark, sf):
    return R.sanction_types(view(spark, sf, "s_sanctions"))


@query("top_respondents", f"""
    SELECT name, {_title_sql("coalesce(entity_type, 'unknown')")} AS type, n AS actions
    FROM (SELECT name, entity_type, count(*) AS n FROM <s_respondents> GROUP BY 1, 2
          ORDER BY n DESC, name, entity_type LIMIT 100) t""")
def top_respondents(spark, sf):
    return R.top_respondents(view(spark, sf, "s_respondents"))


@query("top_statutes", """
    SELECT statute, count(*) AS n FROM <s_violations> WHERE statute IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, statute LIMIT 20""")
def top_statutes(spark, sf):
    return R.top_statutes(view(spark, sf, "s_violations"))


@query("settlement_by_type", f"""
    SELECT action_type, n, n / total AS pct, {_title_sql('action_type')} AS label
    FROM (SELECT action_type, settlement, count(*) AS n, sum(count(*)) OVER (PARTITION BY action_type) AS total
          FROM <s_actions> WHERE settlement IS NOT NULL GROUP BY 1, 2) t
    WHERE settlement""")
def settlement_by_type(spark, sf):
    return R.settlement_by_type(view(spark, sf, "s_actions"))


@query("settlement_by_type_nested", f"""
    SELECT action_type, n, n / total AS pct, {_title_sql('action_type')} AS label
    FROM (SELECT action_type, settlement, count(*) AS n, sum(count(*)) OVER (PARTITION BY action_type) AS total
          FROM ({FLAT_ACTIONS}) f WHERE settlement IS NOT NULL GROUP BY 1, 2) t
    WHERE settlement""")
def settlement_by_type_nested(spark, sf):
    """From nested records straight to the report."""
    return R.settlement_by_type(L.flatten_actions(nested_digests(spark, sf)))


@query("coverage_by_year", """
    SELECT year, on_disk, failed, pending, on_disk + failed AS attempted,
      on_disk / nullif(on_disk + failed, 0) AS coverage_pct
    FROM (SELECT year, count(*) FILTER (download_status IN ('completed', 'skipped')) AS on_disk,
            count(*) FILTER (download_status = 'failed') AS failed,
            count(*) FILTER (download_status = 'pending') AS pending
          FROM <s_manifest> GROUP BY 1) t""")
def coverage_by_year(spark, sf):
    return R.coverage_by_year(view(spark, sf, "s_manifest"))


@query("parse_quality", """
    SELECT year, parsing_status, n, CAST(total AS BIGINT) AS total, n / total AS pct
    FROM (SELECT m.year, p.parsing_status, count(*) AS n, sum(count(*)) OVER (PARTITION BY m.year) AS total
          FROM <s_parsing> p LEFT JOIN <s_manifest> m ON p.pdf_path = m.local_path
          WHERE m.year IS NOT NULL GROUP BY 1, 2) t
    WHERE parsing_status IN ('completed', 'skipped')""")
def parse_quality(spark, sf):
    return R.parse_quality(view(spark, sf, "s_parsing"), view(spark, sf, "s_manifest"))


# --- links -------------------------------------------------------------------

# Anchors by another route: the page is cut at "<a", each piece read on its own.
_LINKS = r"""
    SELECT page_id, url, CAST(row_number() OVER (PARTITION BY page_id ORDER BY cut) - 1 AS INT) AS pos,
      replace(regexp_extract(piece, '^[^>]*\bhref="([^"]*)"', 1), '&amp;', '&') AS href,
      trim(replace(replace(replace(replace(regexp_replace(regexp_replace(
        regexp_extract(piece, '^[^>]*>(.*)$', 1, 's'), '</a>.*$', '', 's'), '<[^>]+>', '', 'g'),
        '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')) AS text
    FROM (SELECT page_id, url, unnest(parts[2:]) AS piece, unnest(range(len(parts) - 1)) AS cut
          FROM (SELECT page_id, url, string_split_regex(regexp_replace(html, '<script.*?</script>', '', 'gs'), '<a\b') AS parts
                FROM pages) p) q"""


def _links(spark, sf):
    return K.page_links(table(spark, sf, "pages"))


@query("page_links", f"SELECT page_id, pos, href, text FROM ({_LINKS}) l")
def page_links(spark, sf):
    return _links(spark, sf).select("page_id", "pos", "href", "text")


@query("links_resolved", f"""
    SELECT page_id, pos, href, CASE
      WHEN href = '' THEN ''
      WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
      WHEN starts_with(href, '//') THEN split_part(url, '//', 1) || href
      WHEN starts_with(href, '/') THEN regexp_extract(url, '^[^/]*//[^/?#]*') || href
      WHEN starts_with(href, '?') THEN regexp_extract(url, '^[^?#]*') || href
      WHEN starts_with(href, '#') THEN split_part(url, '#', 1) || href
      ELSE regexp_extract(url, '^[^/]*//[^/?#]*(?:/[^?#]*/|/|$)?') || href END AS full_url
    FROM ({_LINKS}) l""")
def links_resolved(spark, sf):
    return K.resolved(_links(spark, sf)).select("page_id", "pos", "href", "full_url")


@query("link_counts", f"""
    SELECT p.page_id, count(l.page_id) AS n, count(*) FILTER (regexp_matches(href, '\\.pdf$', 'i')) AS n_pdf
    FROM pages p LEFT JOIN ({_LINKS}) l ON p.page_id = l.page_id GROUP BY 1""")
def link_counts(spark, sf):
    return K.link_counts(table(spark, sf, "pages"))


# The pages hold no archive links, so each anchor's address is made into one of five kinds.
_HREF = """CASE (page_id + pos) % 5
      WHEN 0 THEN concat('/news/digest/', CAST(1956 + page_id % 59 AS VARCHAR(9)), '/dig010785.pdf')
      WHEN 1 THEN concat('/news/digest/', CAST(1956 + page_id % 59 AS VARCHAR(9)), '/dig123199.PDF')
      WHEN 2 THEN concat('/news/digest/', CAST(1956 + page_id % 59 AS VARCHAR(9)), '/')
      WHEN 3 THEN concat('/news/digest/', CAST(1956 + page_id % 59 AS VARCHAR(9)))
      ELSE href END"""
_ARCHIVE = f"(SELECT page_id, pos, {_HREF} AS href, text FROM ({_LINKS}) l) a"


def _archive(spark, sf):
    return _links(spark, sf).withColumn("href", F.expr(_HREF)).select("page_id", "pos", "href", "text")


@query("pdf_links", f"SELECT page_id, pos, href FROM {_ARCHIVE} WHERE regexp_matches(href, '\\.pdf$', 'i')")
def pdf_links(spark, sf):
    return K.pdf_links(_archive(spark, sf)).select("page_id", "pos", "href")


@query("year_links", f"SELECT page_id, pos, href, text FROM {_ARCHIVE} WHERE contains(href, '1985') OR contains(text, '1985')")
def year_links(spark, sf):
    return K.year_links(_archive(spark, sf), 1985)


@query("url_date_parse", f"""
    SELECT page_id, pos, CAST(regexp_extract(href, p, 1) AS INT) AS year, substr(regexp_extract(href, p, 2), 1, 2) AS month,
      substr(regexp_extract(href, p, 2), 3, 2) AS day, substr(regexp_extract(href, p, 2), 5, 2) AS yy
    FROM (SELECT *, '/news/digest/(\\d{{4}})/dig(\\d{{6}})\\.pdf' AS p FROM {_ARCHIVE}) b
    WHERE regexp_matches(href, p)""")
def url_date_parse(spark, sf):
    return K.digest_links(_archive(spark, sf)).select("page_id", "pos", "year", "month", "day", "yy")


@query("year_index_links", f"""
    SELECT page_id, pos, href FROM {_ARCHIVE} WHERE regexp_matches(href, '/\\d{{4}}/$|/\\d{{4}}$')""")
def year_index_links(spark, sf):
    return K.year_index_links(_archive(spark, sf)).select("page_id", "pos", "href")
