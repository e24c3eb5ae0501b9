"""Registered queries: answers, nested records, loading and integrity."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from docketlake.functions import answers as A, text as X
from docketlake.operators import extraction as E, load as L
from docketlake.plans.inputs import (
    FLAT_ACTIONS, FLAT_RESPONDENTS, FLAT_SANCTIONS, FLAT_VIOLATIONS, nested_digests, view,
)
from docketlake.plans.registry import query
from docketlake.plans.stages import load_records
from docketlake.session import scratch_path
from docketlake.sources import files, tables as T

# --- answers -----------------------------------------------------------------

# Cleaning by tokens: a running brace depth over the tokens of each answer.
_TOKEN = r'"(?:[^"\\]|\\.)*"?|[{}]|[^"{}]+'
_CLEAN = f"""
    fenced AS (
      SELECT conv_id, turn, trim(regexp_replace(trim(response, ' ' || chr(10)), '<think>.*?</think>', '', 'gs'), ' ' || chr(10)) AS r
      FROM <s_responses>),
    bare AS (
      SELECT conv_id, turn, trim(CASE WHEN NOT starts_with(r, '```') THEN r
          WHEN ends_with(r, '```') AND len(string_split(r, chr(10))) > 1
            THEN array_to_string(string_split(r, chr(10))[2:-2], chr(10))
          ELSE array_to_string(string_split(r, chr(10))[2:], chr(10)) END, ' ' || chr(10)) AS r
      FROM fenced),
    tokens AS (
      SELECT conv_id, turn, unnest(list) AS tok, unnest(range(len(list))) AS i
      FROM (SELECT conv_id, turn, regexp_extract_all(r, '{_TOKEN}', 0, 's') AS list
            FROM bare WHERE starts_with(r, '{{')) t),
    depths AS (
      SELECT *, sum(CASE tok WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END)
        OVER (PARTITION BY conv_id, turn ORDER BY i) AS depth FROM tokens),
    ends AS (SELECT conv_id, turn, min(i) AS e FROM depths WHERE depth = 0 AND tok = '}}' GROUP BY 1, 2),
    cuts AS (
      SELECT d.conv_id, d.turn, string_agg(tok, '' ORDER BY i) AS cut
      FROM depths d JOIN ends e ON d.conv_id = e.conv_id AND d.turn = e.turn AND d.i <= e.e GROUP BY 1, 2),
    cleaned AS (
      SELECT b.conv_id, b.turn, coalesce(c.cut, b.r) AS cleaned
      FROM bare b LEFT JOIN cuts c ON b.conv_id = c.conv_id AND b.turn = c.turn)"""


@query("clean_response", f"WITH {_CLEAN} SELECT conv_id, turn, cleaned FROM cleaned")
def clean_response(spark, sf):
    return view(spark, sf, "s_responses").select(
        "conv_id", "turn", A.clean_answer(F.col("response")).alias("cleaned"))


@query("parse_response", f"""
    WITH {_CLEAN} SELECT conv_id, turn, json_valid(cleaned) AS ok FROM cleaned""")
def parse_response(spark, sf):
    return view(spark, sf, "s_responses").select(
        "conv_id", "turn", A.parse_answer(A.clean_answer(F.col("response"))).isNotNull().alias("ok"))


_TEXT_OR_NONE = "coalesce(json_type(j, '$.{0}') IN ('VARCHAR', 'NULL'), true)"
_JUDGED = f"""
    {_CLEAN},
    docs AS (
      SELECT conv_id, turn, cleaned, json_valid(cleaned) AS ok,
        CASE WHEN json_valid(cleaned) THEN cleaned END AS d FROM cleaned),
    shapes AS (SELECT *, json_type(d) AS top, json_type(d, '$.actions') AS kind FROM docs),
    elements AS (
      SELECT conv_id, turn, i, json_extract(d, concat('$.actions[', i, ']')) AS j
      FROM (SELECT *, unnest(range(CAST(json_array_length(d, '$.actions') AS BIGINT))) AS i
            FROM shapes WHERE kind = 'ARRAY') s),
    faults AS (
      SELECT conv_id, turn, i, CASE
        WHEN json_type(j) <> 'OBJECT' THEN 'TypeError'
        WHEN json_type(j, '$.action_type') IS DISTINCT FROM 'VARCHAR'
          OR json_type(j, '$.full_text') IS DISTINCT FROM 'VARCHAR'
          OR NOT {_TEXT_OR_NONE.format('title')} OR NOT {_TEXT_OR_NONE.format('court')}
          OR len(list_filter(json_extract(j, '$.respondents[*]'),
               lambda x: json_type(x, '$.name') IS DISTINCT FROM 'VARCHAR')) > 0 THEN 'ValidationError' END AS cls
      FROM elements),
    first_fault AS (
      SELECT conv_id, turn, arg_min(cls, i) AS cls FROM faults WHERE cls IS NOT NULL GROUP BY 1, 2),
    judged AS (
      SELECT s.conv_id, s.turn, d,
        CASE WHEN NOT ok THEN 'JSONDecodeError' WHEN top <> 'OBJECT' THEN 'AttributeError'
          WHEN kind = 'NULL' THEN 'TypeError'
          WHEN f.cls IS NOT NULL THEN f.cls END AS error_class
      FROM shapes s LEFT JOIN first_fault f ON s.conv_id = f.conv_id AND s.turn = f.turn)"""
_OUTCOME = """CASE WHEN error_class IS NULL THEN 'ok'
      WHEN error_class IN ('JSONDecodeError', 'ValidationError') THEN 'failed' ELSE 'error' END"""


@query("validate_response", f"""
    WITH {_JUDGED} SELECT conv_id, turn, {_OUTCOME} AS outcome, error_class FROM judged""")
def validate_response(spark, sf):
    return E.judge_responses(view(spark, sf, "s_responses")).select(
        "conv_id", "turn", "outcome", "error_class")


@query("extraction_outcome", f"""
    WITH {_JUDGED}
    SELECT CAST(DATE '1956-01-01' + CAST((conv_id * 50 + turn) % 21550 AS INT) AS DATE) AS digest_date,
      CASE WHEN error_class IS NULL THEN coalesce(json_array_length(d, '$.actions'), 0) > 0 ELSE true END
        AS has_enforcement_actions,
      CAST(CASE WHEN error_class IS NULL THEN coalesce(json_array_length(d, '$.actions'), 0) ELSE 0 END AS INT)
        AS n_actions,
      CASE WHEN error_class IS NULL THEN json_extract_string(d, '$.actions[0].full_text') END AS first_text,
      CASE WHEN error_class IS NULL THEN
        CASE json_extract_string(d, '$.actions[0].settlement') WHEN 'yes' THEN true WHEN '0' THEN false END
      END AS first_settlement,
      CASE WHEN error_class IS NULL THEN json_extract_string(d, '$.extraction_notes')
        ELSE concat('Extraction failed: ', error_class) END AS extraction_notes,
      {_OUTCOME} AS outcome
    FROM judged""")
def extraction_outcome(spark, sf):
    day = F.date_add(F.lit(datetime.date(1956, 1, 1)), ((F.col("conv_id") * 50 + F.col("turn")) % 21550).cast("int"))
    answers = view(spark, sf, "s_responses").select(day.alias("digest_date"), "response")
    out = E.extraction_outcomes(answers)
    first = F.get("actions", F.lit(0))
    return out.select("digest_date", "has_enforcement_actions", F.size("actions").alias("n_actions"),
                      first["full_text"].alias("first_text"), first["settlement"].alias("first_settlement"),
                      "extraction_notes", "outcome")


@query("extraction_stats", f"""
    WITH {_JUDGED},
    rows AS (
      SELECT CAST(1956 + conv_id % 59 AS INT) AS year, conv_id % 4 = 0 AS done, {_OUTCOME} AS outcome,
        coalesce(json_array_length(d, '$.actions'), 0) AS n FROM judged)
    SELECT year, count(*) FILTER (NOT done) AS total, count(*) FILTER (done) AS skipped,
      count(*) FILTER (NOT done AND outcome <> 'error') AS processed,
      count(*) FILTER (NOT done AND (outcome = 'failed' OR outcome = 'ok' AND n > 0)) AS with_actions,
      CAST(coalesce(sum(n) FILTER (NOT done AND outcome = 'ok'), 0) AS BIGINT) AS total_actions,
      count(*) FILTER (NOT done AND outcome = 'error') AS errors,
      count(*) FILTER (NOT done AND outcome = 'failed') AS failed
    FROM rows GROUP BY ROLLUP (year)""")
def extraction_stats(spark, sf):
    rows = view(spark, sf, "s_responses").withColumn("year", (1956 + F.col("conv_id") % 59).cast("int"))
    todo = rows.where("conv_id % 4 <> 0").withColumn(
        "digest_date", F.make_date("year", F.lit(1), F.lit(1)))
    outcomes = E.extraction_outcomes(todo.select("digest_date", "response")).withColumn(
        "year", F.year("digest_date"))
    return E.extraction_stats(outcomes, rows.where("conv_id % 4 = 0"))


@query("extract_apply", """
    SELECT digest_date, true AS has_enforcement_actions, CAST(n AS VARCHAR) AS first_text, 'ok' AS outcome
    FROM (SELECT digest_date, length(array_to_string(list_filter(string_split(text, chr(10)),
            lambda x: NOT contains(x, '|')), chr(10))) + 7 AS n
          FROM <s_digests> WHERE doc_id % 8 IN (0, 1, 2, 3) OR doc_id % 3 = 0) d""")
def extract_apply(spark, sf):
    """A stand-in extractor that answers with the length of its prompt."""
    def make_client():
        # Local, so that it travels with the job to workers that lack this package.
        def ask(prompt: str) -> str:
            return ('```json\n{"actions":[{"action_type":"civil","full_text":"%d"}]}\n```' % len(prompt))

        return ask

    texts = view(spark, sf, "s_digests")
    found = texts.where(X.has_section(F.col("text")))
    work = E.prompts(found, template="Digest:{content}")
    log = E.call_extractor(work, make_client)
    answered = log.where("http_status = 200").select(F.col("prompt_key").cast("date").alias("digest_date"), "response")
    out = E.extraction_outcomes(answered)
    return out.select("digest_date", "has_enforcement_actions",
                      F.get("actions", F.lit(0))["full_text"].alias("first_text"), "outcome")


# --- nested records ----------------------------------------------------------

@query("extraction_scan", f"""
    SELECT digest_date, i AS pos, action_type, priority AS title, settlement, court, release_number, extraction_notes
    FROM ({FLAT_ACTIONS}) a""")
def extraction_scan(spark, sf):
    """Nested records written as JSON lines, read back by their schema and flattened."""
    path = scratch_path(spark, "extractions")
    nested = nested_digests(spark, sf)
    files.write_extractions(nested.select("*", F.col("year_dir").alias("year")).drop("k", "year_dir", "file_name"), path, fmt="json")
    stored = files.read_extractions(spark, path, fmt="json").where("_corrupt IS NULL")
    return L.flatten_actions(stored).select(
        "digest_date", F.col("pos").cast("bigint").alias("pos"), "action_type", "title", "settlement", "court",
        "release_number", "extraction_notes")


@query("extraction_sink", f"""
    SELECT year_dir AS year, count(*) AS n, CAST(sum(k % 4) AS BIGINT) AS n_actions
    FROM <s_nested_base> GROUP BY 1""")
def extraction_sink(spark, sf):
    path = scratch_path(spark, "extractions")
    nested = nested_digests(spark, sf)
    files.write_extractions(nested.withColumn("year", F.col("year_dir")).drop("k", "year_dir", "file_name"), path)
    return files.read_extractions(spark, path).groupBy("year").agg(
        F.count("*").alias("n"), F.sum(F.size("actions")).alias("n_actions"))


@query("flatten_actions", f"""
    SELECT k, i AS pos, digest_date, action_type, priority AS title, settlement, court, case_number,
      release_number, full_text, extraction_notes FROM ({FLAT_ACTIONS}) a""")
def flatten_actions(spark, sf):
    return L.flatten_actions(nested_digests(spark, sf)).select(
        "k", F.col("pos").cast("bigint").alias("pos"), "digest_date", "action_type", "title", "settlement", "court",
        "case_number", "release_number", "full_text", "extraction_notes")


def _children(spark, sf, kind):
    rows = L.flatten_children(nested_digests(spark, sf), kind)
    return rows.select("k", F.col("action_pos").cast("bigint").alias("i"), F.col("pos").cast("bigint").alias("j"),
                       *L.CHILDREN[kind])


@query("flatten_respondents", f"SELECT k, i, j, name, entity_type, location FROM ({FLAT_RESPONDENTS}) r")
def flatten_respondents(spark, sf):
    return _children(spark, sf, "respondents")


@query("flatten_violations", f"SELECT k, i, j, statute, description FROM ({FLAT_VIOLATIONS}) v")
def flatten_violations(spark, sf):
    return _children(spark, sf, "violations")


@query("flatten_sanctions", f"SELECT k, i, j, sanction_type, description, duration, amount FROM ({FLAT_SANCTIONS}) s")
def flatten_sanctions(spark, sf):
    return _children(spark, sf, "sanctions")


@query("action_profile", f"""
    SELECT k, i AS pos, CAST((k + i) % 3 AS INT) AS n_respondents, CAST((k + 2 * i) % 3 AS INT) AS n_violations,
      CAST((k + i) % 2 AS INT) AS n_sanctions FROM ({FLAT_ACTIONS}) a""")
def action_profile(spark, sf):
    return L.action_profile(nested_digests(spark, sf)).select(
        "k", F.col("pos").cast("bigint").alias("pos"), "n_respondents", "n_violations", "n_sanctions")


# --- ids and loading ---------------------------------------------------------

_ORDER = ["year_dir", "file_name"]
_SKIP = "digest_date < DATE '1998-01-01'"


def _loaded_days(spark, sf):
    return L.day_bitmaps(view(spark, sf, "s_nested_base").where(_SKIP))


def _placed(spark, sf):
    """New digests with actions and their offsets; the dates before 1998 count as loaded."""
    nested = nested_digests(spark, sf)
    return L.with_offsets(L.classify(nested, _loaded_days(spark, sf)).where("load_outcome = 'loaded'"), _ORDER)


@query("surrogate_ids", f"""
    SELECT 100 + row_number() OVER (ORDER BY year_dir, file_name, i) AS id, k, i AS pos, digest_date
    FROM ({FLAT_ACTIONS}) a WHERE NOT ({_SKIP}) AND has_enforcement_actions""")
def surrogate_ids(spark, sf):
    return L.flatten_actions(_placed(spark, sf), 101).select("id", "k", F.col("pos").cast("bigint").alias("pos"), "digest_date")


@query("surrogate_child_ids", f"""
    WITH a AS (
      SELECT k, i, row_number() OVER (ORDER BY year_dir, file_name, i) AS id
      FROM ({FLAT_ACTIONS}) f WHERE NOT ({_SKIP}) AND has_enforcement_actions)
    SELECT 7 + row_number() OVER (ORDER BY r.digest_date, r.file_name, r.i, r.j) AS id, a.id AS action_id, r.name
    FROM ({FLAT_RESPONDENTS}) r JOIN a ON r.k = a.k AND r.i = a.i
    WHERE NOT ({_SKIP}) AND has_enforcement_actions""")
def surrogate_child_ids(spark, sf):
    return L.flatten_children(_placed(spark, sf), "respondents", 1, 8).select("id", "action_id", "name")


@query("next_ids", """
    SELECT (SELECT coalesce(max(id), 0) + 1 FROM <s_actions>) AS enforcement_actions,
      (SELECT coalesce(max(id), 0) + 1 FROM <s_respondents>) AS respondents,
      (SELECT coalesce(max(id), 0) + 1 FROM <s_violations>) AS violations,
      (SELECT coalesce(max(id), 0) + 1 FROM <s_sanctions>) AS sanctions""")
def next_ids(spark, sf):
    return L.next_ids({
        "enforcement_actions": view(spark, sf, "s_actions"), "respondents": view(spark, sf, "s_respondents"),
        "violations": view(spark, sf, "s_violations"), "sanctions": view(spark, sf, "s_sanctions")})


@query("incremental_load", f"""
    SELECT k, digest_date FROM <s_nested_base>
    WHERE digest_date NOT IN (SELECT digest_date FROM <s_nested_base> WHERE {_SKIP} OR day(digest_date) = 1)""")
def incremental_load(spark, sf):
    digests = view(spark, sf, "s_nested_base").select("k", "digest_date")
    days = L.day_bitmaps(digests.where(f"{_SKIP} OR day(digest_date) = 1"))
    return L.not_loaded(digests, days)


@query("load_no_actions", f"""
    SELECT digest_date, count(*) AS n FROM <s_nested_base>
    WHERE NOT ({_SKIP}) AND NOT (has_enforcement_actions AND k % 4 > 0) GROUP BY 1""")
def load_no_actions(spark, sf):
    nested = nested_digests(spark, sf)
    out = L.classify(nested, _loaded_days(spark, sf))
    return out.where("load_outcome = 'no_actions'").groupBy("digest_date").agg(F.count("*").alias("n"))


@query("load_repeated_dates", f"""
    SELECT digest_date, count(*) AS n FROM <s_nested_base>
    WHERE NOT ({_SKIP}) AND has_enforcement_actions AND k % 4 > 0 GROUP BY 1 HAVING count(*) > 1""")
def load_repeated_dates(spark, sf):
    nested = nested_digests(spark, sf)
    return L.repeated_dates(L.classify(nested, _loaded_days(spark, sf)))


_STATS_SQL = f"""
    SELECT count(*) FILTER (NOT old AND good) AS loaded, count(*) FILTER (old) AS skipped_existing,
      count(*) FILTER (NOT old AND NOT good) AS no_actions, CAST(0 AS BIGINT) AS errors,
      CAST(sum(k % 4) FILTER (NOT old AND good) AS BIGINT) AS total_actions,
      count(*) FILTER (NOT old AND NOT good AND has_enforcement_actions) AS failed,
      count(*) FILTER (NOT old AND good) - count(DISTINCT digest_date) FILTER (NOT old AND good) AS repeated_dates
    FROM (SELECT k, digest_date, {_SKIP} AS old, has_enforcement_actions, has_enforcement_actions AND k % 4 > 0 AS good
          FROM <s_nested_base>) b"""


@query("stage_stats", _STATS_SQL)
def stage_stats(spark, sf):
    nested = nested_digests(spark, sf)
    return L.load_stats(L.classify(nested, _loaded_days(spark, sf)))


@query("table_sink", f"""
    SELECT 'enforcement_actions' AS "table", count(*) AS n, CAST(max(id) AS BIGINT) AS max_id
    FROM (SELECT row_number() OVER () AS id FROM ({FLAT_ACTIONS}) a WHERE has_enforcement_actions) t
    UNION ALL SELECT 'respondents', count(*), count(*) FROM ({FLAT_RESPONDENTS}) r WHERE has_enforcement_actions
    UNION ALL SELECT 'violations', count(*), count(*) FROM ({FLAT_VIOLATIONS}) v WHERE has_enforcement_actions
    UNION ALL SELECT 'sanctions', count(*), count(*) FROM ({FLAT_SANCTIONS}) s WHERE has_enforcement_actions""")
def table_sink(spark, sf):
    """Two loads, years before 1998 first; a third load of the same records adds nothing."""
    base, nested = scratch_path(spark, "base"), nested_digests(spark, sf)
    load_records(spark, base, nested.where(_SKIP), _ORDER)
    load_records(spark, base, nested, _ORDER)
    load_records(spark, base, nested, _ORDER)
    return _table_counts(T.enforcement_tables(spark, base))


def _table_counts(tables):
    out = None
    for name, df in tables.items():
        one = df.select(F.lit(name).alias("table"), "id")
        out = one if out is None else out.unionAll(one)
    return out.groupBy("table").agg(F.count("*").alias("n"), F.max("id").alias("max_id"))


@query("full_reload", f"""
    SELECT CAST(year(digest_date) AS INT) AS year, count(*) AS n FROM ({FLAT_ACTIONS}) a
    WHERE has_enforcement_actions GROUP BY 1""")
def full_reload(spark, sf):
    """All records loaded, then two of the years loaded anew in their place."""
    base, nested = scratch_path(spark, "base"), nested_digests(spark, sf)
    load_records(spark, base, nested, _ORDER)
    load_records(spark, base, nested, _ORDER, replace_years=[1996, 1999])
    actions = T.enforcement_tables(spark, base)["enforcement_actions"]
    return actions.groupBy("year").agg(F.count("*").alias("n"))


# --- integrity ---------------------------------------------------------------

@query("fk_orphans", """
    SELECT 'sanctions' AS "table", count(*) AS n FROM <s_sanctions> s
    WHERE action_id NOT IN (SELECT id FROM <s_actions>)""")
def fk_orphans(spark, sf):
    children = {n: view(spark, sf, f"s_{n}") for n in ("respondents", "violations", "sanctions")}
    return L.orphans(children, view(spark, sf, "s_actions"))


def _keys_sql(name: str, nulls: str) -> str:
    return f"""SELECT '{name}' AS "table",
      (SELECT count(*) FROM (SELECT id FROM <s_{name}> WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) d) AS repeated_keys,
      (SELECT count(*) FROM <s_{name}> WHERE {nulls}) AS null_rows"""


@query("pk_violations", " UNION ALL ".join([
    _keys_sql("actions", "id IS NULL OR digest_date IS NULL OR action_type IS NULL").replace(
        "'actions'", "'enforcement_actions'"),
    _keys_sql("respondents", "id IS NULL OR action_id IS NULL OR name IS NULL"),
    _keys_sql("violations", "id IS NULL OR action_id IS NULL"),
    _keys_sql("sanctions", "id IS NULL OR action_id IS NULL")]))
def pk_violations(spark, sf):
    return L.key_violations({
        "enforcement_actions": view(spark, sf, "s_actions"), "respondents": view(spark, sf, "s_respondents"),
        "violations": view(spark, sf, "s_violations"), "sanctions": view(spark, sf, "s_sanctions")})


def _list_sql(kind: str, *fields: str) -> str:
    texts = " || '|' || ".join(f"coalesce({f}, '')" for f in fields)
    order = ", ".join(f"{f} NULLS FIRST" for f in ("id", *fields))
    return f"""(SELECT action_id, (rank - 1) // {_PAGE} AS page,
        string_agg(concat(CAST(id AS VARCHAR), '|') || {texts}, ';' ORDER BY {order}) AS {kind}
      FROM (SELECT *, row_number() OVER (PARTITION BY action_id ORDER BY {order}) AS rank FROM <s_{kind}>) c
      GROUP BY ALL)"""


_PAGE = 3


@query("renest_actions", f"""
    WITH r AS {_list_sql('respondents', 'name', 'entity_type', 'location')},
    v AS {_list_sql('violations', 'statute', 'description')},
    s AS {_list_sql('sanctions', 'sanction_type', 'description', 'duration', 'amount')},
    p AS (SELECT action_id, page FROM r UNION SELECT action_id, page FROM v UNION SELECT action_id, page FROM s)
    SELECT a.*, coalesce(p.page, 0) AS page, coalesce(respondents, '') AS respondents,
      coalesce(violations, '') AS violations, coalesce(sanctions, '') AS sanctions
    FROM <s_actions> a LEFT JOIN p ON p.action_id = a.id
    LEFT JOIN r ON r.action_id = a.id AND r.page = p.page LEFT JOIN v ON v.action_id = a.id AND v.page = p.page
    LEFT JOIN s ON s.action_id = a.id AND s.page = p.page""")
def renest_actions(spark, sf):
    """Actions with all their children in pages; the lists are written out to compare them."""
    children = {n: view(spark, sf, f"s_{n}") for n in L.CHILDREN}
    pages = L.assemble_actions(view(spark, sf, "s_actions"), children, _PAGE)

    def written(kind):
        return F.array_join(F.transform(kind, lambda c: F.concat_ws(
            "|", c["id"].cast("string"), *[F.coalesce(c[f], F.lit("")) for f in L.CHILDREN[kind]])), ";")

    return pages.withColumns({kind: written(kind) for kind in L.CHILDREN})


@query("action_overview", """
    SELECT a.id, coalesce(r.n, 0) AS n_resp, coalesce(v.n, 0) AS n_viol, coalesce(s.n, 0) AS n_sanc, r.first_name
    FROM <s_actions> a
    LEFT JOIN (SELECT action_id, count(*) AS n, arg_min(name, id) AS first_name FROM <s_respondents> GROUP BY 1) r
      ON a.id = r.action_id
    LEFT JOIN (SELECT action_id, count(*) AS n FROM <s_violations> GROUP BY 1) v ON a.id = v.action_id
    LEFT JOIN (SELECT action_id, count(*) AS n FROM <s_sanctions> GROUP BY 1) s ON a.id = s.action_id""")
def action_overview(spark, sf):
    return L.action_overview(view(spark, sf, "s_actions"), view(spark, sf, "s_respondents"),
                             view(spark, sf, "s_violations"), view(spark, sf, "s_sanctions"))


@query("table_exists", """
    SELECT 'orders.parquet' AS "table", true AS present, (SELECT count(*) FROM orders) AS n
    UNION ALL SELECT 'lineitem.parquet', true, (SELECT count(*) FROM lineitem)
    UNION ALL SELECT 'enforcement_actions', false, 0""")
def table_exists(spark, sf):
    """Rows of two tables that are there and of one that is not."""
    keys = {"orders.parquet": "o_orderkey BIGINT", "lineitem.parquet": "l_orderkey BIGINT",
            "enforcement_actions": "id BIGINT"}
    out = None
    for name, schema in keys.items():
        present = T.tables_present(spark, sf, [name])
        one = T.read_or_empty(spark, f"{sf}/{name}", schema).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table"), F.lit(present).alias("present"), "n")
        out = one if out is None else out.unionAll(one)
    return out
