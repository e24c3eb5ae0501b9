"""Registered queries: raw files, texts, pre-filter and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketlake.functions import html as H, text as X, urls
from docketlake.functions.labels import kilochars, megabytes, spaced_label
from docketlake.functions.prompts import DEFAULT_TEMPLATE
from docketlake.operators import extraction as E, parsing as P
from docketlake.operators.keys import top_per_group
from docketlake.plans.inputs import table, view
from docketlake.plans.registry import query
from docketlake.session import drop_scratch, scratch_path
from docketlake.sources import files
from docketlake.sources.pending import read_pending

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160) || chr(8195) || chr(12288)"
_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _html_to_text_sql(column: str) -> str:
    """The same conversion over arrays of lines; enough for the entities the pages hold."""
    tags = f"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({column},
        '<script[\\s\\S]*?</script>', '', 'gi'), '<style[\\s\\S]*?</style>', '', 'gi'),
        '</?(p|div|br|li|tr|h[1-6])[^>]*>', chr(10), 'gi'), '<[^>]+>', '', 'g')"""
    decoded = tags
    for entity, char in (("&quot;", "'\"'"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&amp;", "'&'")):
        decoded = f"regexp_replace({decoded}, '{entity}?', {char}, 'g')"
    return f"""array_to_string(list_filter(list_transform(
        string_split_regex({decoded}, '{_BREAKS}'), lambda x: trim(x, {_SPACES})), lambda x: x <> ''), chr(10))"""


@query("text_normalize", """
    SELECT doc_id, length(t) AS n_chars, len(string_split(t, chr(10))) AS n_lines
    FROM (SELECT doc_id, regexp_replace(replace(text, chr(10), chr(13) || chr(10)) || chr(13) || 'end',
            '\\r\\n?', chr(10), 'g') AS t FROM documents) d""")
def text_normalize(spark, sf):
    raw = F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\rend")).cast("binary")
    docs = table(spark, sf, "documents").select("doc_id", X.decode_bytes(raw).alias("t"))
    return docs.select("doc_id", F.length("t").cast("bigint").alias("n_chars"),
                       X.line_count(F.col("t")).cast("bigint").alias("n_lines"))


@query("html_to_text", f"""
    SELECT page_id, length(t) AS n_chars, t AS text
    FROM (SELECT page_id, {_html_to_text_sql('html')} AS t FROM pages) p""")
def html_to_text(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", H.html_to_text(F.col("html")).alias("text"))
    return pages.select("page_id", F.length("text").cast("bigint").alias("n_chars"), "text")


_PAGE_PATH = """concat('raw/', CASE WHEN page_id % 5 = 0 THEN 'misc' ELSE CAST(1956 + page_id % 59 AS VARCHAR(9)) END,
    '/digest_', CAST(page_id AS VARCHAR(20)), CASE page_id % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.txt'
    WHEN 2 THEN '.htm' WHEN 3 THEN '.HTML' WHEN 4 THEN '.v2.doc' ELSE '' END)"""
_KIND = """CASE ext WHEN '.pdf' THEN 'pdf' WHEN '.txt' THEN 'text' WHEN '.htm' THEN 'html'
    WHEN '.html' THEN 'html' ELSE 'unsupported' END"""


@query("parse_dispatch", f"""
    SELECT path, ext, {_KIND} AS kind, year_dir,
      concat('markdown/', year_dir, '/', regexp_extract(path, '([^/]*?)(\\.[^./]+)?$', 1), '.md') AS out_path
    FROM (SELECT path, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS ext,
            CASE WHEN page_id % 5 = 0 THEN 'unknown' ELSE CAST(1956 + page_id % 59 AS VARCHAR) END AS year_dir
          FROM (SELECT page_id, {_PAGE_PATH} AS path FROM pages) p) q""")
def parse_dispatch(spark, sf):
    path = F.col("path")
    return table(spark, sf, "pages").select(F.expr(_PAGE_PATH).alias("path")).select(
        path, urls.file_suffix(path).alias("ext"), urls.source_kind(path).alias("kind"),
        urls.year_folder(path).alias("year_dir"), urls.text_path(path, "markdown").alias("out_path"))


@query("parse_files", f"""
    SELECT path, CASE kind WHEN 'unsupported' THEN 'failed' WHEN 'pdf' THEN 'needs_converter'
        ELSE 'completed' END AS parsing_status,
      CAST(CASE kind WHEN 'text' THEN length(html) WHEN 'html' THEN length({_html_to_text_sql('html')}) END AS INT)
        AS markdown_length,
      CASE kind WHEN 'unsupported' THEN concat('Unsupported file type: ', ext) END AS error_message
    FROM (SELECT *, {_KIND} AS kind
          FROM (SELECT *, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS ext
                FROM (SELECT html, {_PAGE_PATH} AS path FROM pages) p) q) r""")
def parse_files(spark, sf):
    raw = table(spark, sf, "pages").select(
        F.expr(_PAGE_PATH).alias("path"), F.col("html").cast("binary").alias("content"))
    return P.parse_files(raw).select("path", "parsing_status", "markdown_length", "error_message")


@query("text_preview", """
    SELECT doc_id, substr(text, 1, 500) AS preview, substr(text, 1, 200) AS diagnostic FROM <s_digests>""")
def text_preview(spark, sf):
    return view(spark, sf, "s_digests").select(
        "doc_id", X.preview(F.col("text"), 500).alias("preview"), X.preview(F.col("text"), 200).alias("diagnostic"))


@query("page_text_preview", f"""
    SELECT page_id, substr({_html_to_text_sql('html')}, 1, 2000) AS preview FROM pages""")
def page_text_preview(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", X.preview(H.html_to_text(F.col("html")), 2000).alias("preview"))


# --- pre-filter --------------------------------------------------------------

_PATTERNS = [p.replace(X.SPACE, r"\s") for p in X.SECTION_PATTERNS]
_HAS = " OR ".join(f"regexp_matches(text, '{p}', 'i')" for p in _PATTERNS)


@query("prefilter", f"SELECT doc_id, {_HAS} AS has_actions FROM <s_digests>")
def prefilter(spark, sf):
    return E.prefilter(view(spark, sf, "s_digests")).select("doc_id", "has_actions")


def _sections_sql() -> str:
    """Contexts by running offsets over the cut text."""
    parts = []
    for i, p in enumerate(_PATTERNS):
        parts.append(f"""
      SELECT doc_id, {i} AS p, text, string_split_regex(text, '(?i){p}') AS g,
        regexp_extract_all(text, '(?i){p}') AS m FROM <s_digests>""")
    return f"""
    WITH cut AS ({' UNION ALL '.join(parts)}),
    placed AS (
      SELECT doc_id, p, text, unnest(range(len(m))) AS i, g, m FROM cut),
    spans AS (
      SELECT doc_id, p, i, text, length(m[i + 1]) AS n,
        CAST(list_sum(list_transform(g[1:i + 1], lambda x: length(x)))
          + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0) AS BIGINT) AS s
      FROM placed)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p, i) - 1 AS INT) AS pos,
      trim(substr(text, greatest(s - 50, 0) + 1, s + n + 50 - greatest(s - 50, 0)), {_SPACES}) AS section
    FROM spans"""


@query("prefilter_sections", _sections_sql())
def prefilter_sections(spark, sf):
    return view(spark, sf, "s_digests").select("doc_id", F.posexplode(X.section_contexts(F.col("text"))).alias("pos", "section"))


@query("prefilter_tally", f"""
    SELECT has_actions, count(*) AS n FROM (SELECT {_HAS} AS has_actions FROM <s_digests>) d GROUP BY 1""")
def prefilter_tally(spark, sf):
    return E.prefilter_tally(view(spark, sf, "s_digests"))


@query("strip_tables", """
    SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT contains(x, '|')), chr(10)) AS text
    FROM <s_digests>""")
def strip_tables(spark, sf):
    return view(spark, sf, "s_digests").select("doc_id", X.drop_table_lines(F.col("text")).alias("text"))


_BEFORE, _AFTER = (part.replace("'", "''") for part in DEFAULT_TEMPLATE.split("{content}"))


@query("build_prompt", f"""
    SELECT doc_id, '{_BEFORE}' || array_to_string(list_filter(string_split(text, chr(10)),
      lambda x: NOT contains(x, '|')), chr(10)) || '{_AFTER}' AS prompt
    FROM <s_digests>""")
def build_prompt(spark, sf):
    return E.prompts(view(spark, sf, "s_digests")).select("doc_id", "prompt")


@query("digest_date_parse", """
    SELECT name, try_cast(regexp_extract(name, '^digest_(\\d{4}-\\d{2}-\\d{2})\\.md$', 1) AS DATE) AS digest_date
    FROM (SELECT concat('digest_', CASE doc_id % 4 WHEN 3 THEN concat('1985-02-', CAST(28 + doc_id % 5 AS VARCHAR(9)))
            ELSE CAST(digest_date AS VARCHAR(10)) END, '.md') AS name FROM <s_digests>) d""")
def digest_date_parse(spark, sf):
    # One name in four carries a day that may not exist.
    day = F.when(F.col("doc_id") % 4 == 3,
                 F.concat(F.lit("1985-02-"), (28 + F.col("doc_id") % 5).cast("string"))
                 ).otherwise(F.col("digest_date").cast("string"))
    names = view(spark, sf, "s_digests").select(F.concat(F.lit("digest_"), day, F.lit(".md")).alias("name"))
    return names.select("name", urls.digest_date_from_name(F.col("name")).alias("digest_date"))


@query("limit_per_year", f"""
    SELECT year, doc_id, CAST(rn AS INT) AS rn
    FROM (SELECT year, doc_id, row_number() OVER (PARTITION BY year ORDER BY doc_id) AS rn
          FROM <s_digests> WHERE {_HAS}) d
    WHERE rn <= 3""")
def limit_per_year(spark, sf):
    found = view(spark, sf, "s_digests").where(X.has_section(F.col("text"))).select("year", "doc_id")
    return top_per_group(found, "year", "doc_id", 3)


@query("pending_digests", f"""
    SELECT year, doc_id
    FROM (SELECT year, doc_id, row_number() OVER (PARTITION BY year ORDER BY doc_id) AS rn
          FROM <s_digests> WHERE ({_HAS})
            AND digest_date NOT IN (SELECT digest_date FROM <s_digests> WHERE doc_id % 3 = 0)) d
    WHERE rn <= 2""")
def pending_digests(spark, sf):
    texts = view(spark, sf, "s_digests")
    done = texts.where("doc_id % 3 = 0").select("digest_date")
    return E.pending_digests(texts, done, limit=2, order="doc_id").select("year", "doc_id")


# --- files -------------------------------------------------------------------

@query("digest_scan", """
    SELECT year, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars
    FROM <s_digests> WHERE year BETWEEN 1970 AND 1989 GROUP BY 1""")
def digest_scan(spark, sf):
    path = scratch_path(spark, "digest_text")
    files.write_texts(view(spark, sf, "s_digests"), path)
    stored = files.read_texts(spark, path).where(F.col("year").between(1970, 1989))
    return stored.groupBy("year").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query("digest_text_sink", """SELECT year, doc_id, digest_date, text FROM <s_digests>""")
def digest_text_sink(spark, sf):
    path = scratch_path(spark, "digest_text")
    files.write_texts(view(spark, sf, "s_digests"), path)
    return files.read_texts(spark, path).select("year", "doc_id", "digest_date", "text")


_SUFFIXES = [".txt", ".htm", ".pdf", ".html"]


@query("raw_files", """
    SELECT CAST(year AS VARCHAR) AS year_dir,
      CASE rank % 4 WHEN 0 THEN '.txt' WHEN 1 THEN '.htm' WHEN 2 THEN '.pdf' ELSE '.html' END AS suffix,
      n_chars, n_line_ends
    FROM (SELECT year, row_number() OVER (ORDER BY year) - 1 AS rank, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars,
            CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_line_ends
          FROM <s_digests> GROUP BY 1) y""")
def raw_files(spark, sf):
    """Texts written as files of all four suffixes below year folders, listed, and their bytes read in the tasks."""
    root, staged, names = scratch_path(spark, "raw"), scratch_path(spark, "raw-staged"), scratch_path(spark, "names")
    texts = view(spark, sf, "s_digests").select("year", "text")
    files.balanced(texts, "year").write.partitionBy("year").option("maxRecordsPerFile", 1000).text(staged)
    files.plain_folders(spark, staged, root, "year", _SUFFIXES)
    drop_scratch(spark, staged)
    read = read_pending(spark, files.raw_files(spark, root), names)
    decoded = read.select(urls.year_folder(F.col("path")).alias("year_dir"), urls.file_suffix(F.col("path")).alias("suffix"),
                          X.decode_bytes(F.col("content")).alias("t"))
    return decoded.groupBy("year_dir", "suffix").agg(
        F.sum(F.length("t")).alias("n_chars"), F.sum(X.line_count(F.col("t")) - 1).alias("n_line_ends"))


# --- labels ------------------------------------------------------------------

@query("label_title", """
    SELECT raw, n, array_to_string(list_transform(string_split(replace(raw, '_', ' '), ' '),
      lambda w: array_to_string(list_transform(string_split(w, '-'), lambda h: upper(h[1]) || lower(h[2:])), '-')), ' ') AS label
    FROM (SELECT sanction_type AS raw, count(*) AS n FROM <s_sanctions>
          WHERE sanction_type IS NOT NULL GROUP BY 1) s""")
def label_title(spark, sf):
    raw = view(spark, sf, "s_sanctions").where("sanction_type IS NOT NULL")
    counted = raw.groupBy(F.col("sanction_type").alias("raw")).agg(F.count("*").alias("n"))
    return counted.withColumn("label", spaced_label(F.col("raw")))


@query("size_labels", """
    SELECT year, printf('%.2f', sum(file_size_bytes) * 100 / 1048576.0) AS mb,
      printf('%.1f', sum(file_size_bytes) / 1000.0) AS k
    FROM <s_manifest> GROUP BY 1""")
def size_labels(spark, sf):
    sums = view(spark, sf, "s_manifest").groupBy("year").agg(F.sum("file_size_bytes").alias("b"))
    return sums.select("year", megabytes(F.col("b") * 100).alias("mb"), kilochars(F.col("b")).alias("k"))
